"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (n = 1 to 3, blended spectrum, presence only) that both contain,
over the root of the product of their own numbers. N-grams are hashed into ``buckets`` features. Nyström: the kernel against a
bounded set of landmark texts stands for the full kernel matrix, and one-versus-rest kernel ridge regression is solved in that
space. A batch of texts is scored by two matrix products: presence x landmarks, kernel x weights.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import held_out, stored, text_slices, to_batch, wider

UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and of the kernel. Every language is learned, however many there are.

    train_docs, landmarks: most of one language. all_docs, all_landmarks: of all languages together, shared out evenly; a language keeps at
    least least_docs documents and one landmark.
    """

    train_docs: int = 400
    landmarks: int = 48
    all_docs: int = 12_800
    all_landmarks: int = 1_536
    least_docs: int = 8
    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 14
    ridge: float = 1e-3
    batch_docs: int = 256

    def docs_of(self, languages: int) -> int:
        return max(self.least_docs, min(self.train_docs, self.all_docs // languages))

    def landmarks_of(self, languages: int) -> int:
        return max(1, min(self.landmarks, self.all_landmarks // languages))


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray
    settings: Settings


def letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def presence(texts: list[str], s: Settings) -> np.ndarray:
    """One row per text, 1 where an n-gram of the lower-cased whole text falls in the bucket, else 0."""
    out = np.zeros((len(texts), s.buckets), dtype=bool)
    shift = np.uint64(64 - (s.buckets.bit_length() - 1))
    for row, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
        grams = codes + np.uint64(1)
        for n in range(1, max(s.orders) + 1):
            if n > 1:
                grams = grams[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(1)
            if not len(grams):
                break
            if n in s.orders:
                out[row, ((grams * _MIX) >> shift).astype(np.int64)] = True
    return out


def kernel(present: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of a batch against the landmarks; 0 for an empty text."""
    own = np.sqrt(np.maximum(1, np.count_nonzero(present, axis=1)))
    other = np.sqrt(np.maximum(1.0, landmarks.sum(axis=1)))
    return (present.astype(np.float32) @ landmarks.T) / own[:, None] / other[None, :]


def solve(present: np.ndarray, labels: np.ndarray, landmark_rows: np.ndarray, s: Settings) -> np.ndarray:
    """Weights (landmarks + 1 offset, languages) of one-versus-rest ridge regression in the Nyström space."""
    landmarks = present[landmark_rows].astype(np.float32)
    cross = np.concatenate([kernel(present[a : a + 1024], landmarks) for a in range(0, len(present), 1024)]).astype(float)
    inner = cross[landmark_rows]
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = np.column_stack([cross @ root, np.ones(len(cross))])
    goal = (labels[:, None] == np.arange(labels.max() + 1)[None, :]).astype(float)
    balance = 1 / goal.sum(axis=0)[labels]  # every language weighs the same
    weighted = features * balance[:, None]
    beta = np.linalg.solve(features.T @ weighted + s.ridge * np.eye(features.shape[1]), weighted.T @ goal)
    return np.vstack([root @ beta[:-1], beta[-1:]])


def fit(docs: DataFrame, settings: Settings | None = None) -> Model | None:
    """The model from a bounded sample: of each language, the training rows with the smallest hash of their id.

    Rows with a null language, a null text or no letter teach nothing and take no place in the sample. Every other language is learned.
    None if there is nothing to learn from. Only hashed presence bits of the sample reach the driver.
    """
    s = settings or Settings()
    usable = F.col("lang").isNotNull() & ~held_out("doc_id") & F.col("text").rlike("\\p{L}")
    known = docs.where(usable).select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang")
    # first within 64 parts of a language, so that no task gets more than 64 * train_docs rows of a frequent one
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    nearly = known.withColumn("_rank", F.row_number().over(parts)).where(F.col("_rank") <= s.train_docs)
    nearly = stored(nearly.select("doc_id", "lang"), "languages")
    languages = nearly.select("lang").distinct().count()
    if not languages:
        return None
    first = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = nearly.withColumn("_rank", first).where(F.col("_rank") <= s.docs_of(languages))
    ids = [(r.doc_id, r.lang) for r in ranked.collect()]
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id bigint, lang string")
    sample = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text").where("text IS NOT NULL").join(F.broadcast(chosen), ["doc_id", "lang"])
    schema = pa.schema([("lang", pa.string()), ("doc_id", pa.int64()), ("bits", pa.binary())])

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            keep = [i for i, t in enumerate(texts) if letters(t)]
            rows = [np.packbits(presence([texts[i]], s)[0]).tobytes() for i in keep]
            part = part.take(pa.array(keep, pa.int64()))
            yield to_batch(schema, part.column("lang"), part.column("doc_id"), rows)

    rows = (
        sample.mapInArrow(packed, "lang string, doc_id bigint, bits binary")
        .groupBy("lang", "doc_id").agg(F.min("bits").alias("bits")).orderBy("lang", F.xxhash64("doc_id"), "doc_id").collect()
    )
    if not rows:
        return None
    names = sorted({r.lang for r in rows})
    labels = np.array([names.index(r.lang) for r in rows])
    bits = np.unpackbits(np.array([np.frombuffer(r.bits, np.uint8) for r in rows]), axis=1).astype(bool)
    landmark_rows = np.concatenate([np.flatnonzero(labels == k)[: s.landmarks_of(len(names))] for k in range(len(names))])
    weights = solve(bits, labels, landmark_rows, s)
    return Model(tuple(names), np.packbits(bits[landmark_rows], axis=1), weights.astype(np.float32), s)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` and lang_pred string, score double, from the whole text alone.

    lang_pred is ``und`` with score 0 for a null text, a text without a letter, or an untrained model; ties go to the first
    name in order. score is the clipped regression value of the winner. Columns of these names in ``docs`` are replaced.
    """
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*rest)
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = model.settings
        landmarks = np.unpackbits(model.landmarks, axis=1).astype(np.float32)
        used = np.flatnonzero(landmarks.any(axis=0))
        other = np.sqrt(np.maximum(1.0, landmarks.sum(axis=1)))
        columns = np.ascontiguousarray(landmarks[:, used].T)
        for part, texts in text_slices(batches):
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            spoken = [i for i, t in enumerate(texts) if letters(t)]
            for a in range(0, len(spoken), s.batch_docs):
                at = spoken[a : a + s.batch_docs]
                bits = presence([texts[i] for i in at], s)
                own = np.sqrt(np.maximum(1, np.count_nonzero(bits, axis=1)))
                near = (bits[:, used].astype(np.float32) @ columns) / own[:, None] / other[None, :]
                value = near @ model.weights[:-1] + model.weights[-1]
                best = value.argmax(axis=1)
                scores[at] = np.clip(value[np.arange(len(at)), best], 0, 1)
                for i, k in zip(at, best, strict=True):
                    names[i] = model.names[k]
            kept = [part.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores)], names=[*rest, "lang_pred", "score"])

    return docs.mapInArrow(run, wider(docs, lang_pred="string", score="double"))
