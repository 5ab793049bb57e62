"""Quality classifier by compression: how much smaller a text gets with a dictionary of good text than with one of bad text.

Two zstandard dictionaries are trained on labelled text, one per label. Every whole text is cut into blocks that are compressed
on their own with either dictionary; the difference of the summed sizes over the number of bytes is the only feature, and a
logistic curve fitted on other labelled documents turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import held_out, text_slices, to_batch, wider


@dataclass(frozen=True)
class Sampling:
    """Bounds of the labelled sample and of the dictionaries; scoring has no bound.

    dictionary_docs, calibration_docs: most documents of each label for either use, those with the smallest hash of the id.
    blocks_per_doc: most blocks of a document that train a dictionary, evenly spaced over the whole text.
    """

    dictionary_docs: int = 1000
    calibration_docs: int = 3000
    blocks_per_doc: int = 16
    block_bytes: int = 2048
    dictionary_bytes: int = 65536
    level: int = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    raw: bool
    slope: float
    offset: float
    block_bytes: int
    level: int


def _blocks(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def _compressor(content: bytes, raw: bool, level: int) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind)
    dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)


class Gain:
    """Normalised size difference of a text; positive: closer to good text. 0 for an empty text."""

    def __init__(self, model: Model):
        self.good = _compressor(model.good, model.raw, model.level)
        self.bad = _compressor(model.bad, model.raw, model.level)
        self.size = model.block_bytes

    def __call__(self, text: str) -> float:
        data = text.encode("utf-8", "replace")
        diff = 0
        for block in _blocks(data, self.size):
            diff += len(self.bad.compress(block)) - len(self.good.compress(block))
        return diff / max(1, len(data))


def train_dictionaries(good: list[bytes], bad: list[bytes], size: int) -> tuple[bytes, bytes, bool]:
    """Both dictionaries, and whether they are plain content because there was too little text to train on."""
    try:
        return zstandard.train_dictionary(size, good).as_bytes(), zstandard.train_dictionary(size, bad).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(good)[:size], b"".join(bad)[:size], True


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of P(y = 1) by Newton's method; ``x`` is scaled inside, the slope is never negative."""
    scale = float(np.std(x)) or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + ridge * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0]) / scale), float(beta[1])


def _labelled(labels: DataFrame, label: str, per_class: int) -> list[tuple[int, int]]:
    """At most ``per_class`` training ids of each label; ids labelled both ways teach nothing."""
    clear = (
        labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).alias("_most"))
        .where("label = _most")
    )
    found = []
    for value in (0, 1):
        top = clear.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        found += [(r.doc_id, value) for r in top.select("doc_id").collect()]
    return found


def _sampled(docs: DataFrame, ids: list[tuple[int, int]]) -> DataFrame:
    """Texts of a bounded list of ids."""
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id bigint, label int")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sampling: Sampling | None = None) -> Model | float:
    """The model, or one score for all texts if a label has no training text."""
    s = sampling or Sampling()
    ids = _labelled(labels, label, s.dictionary_docs + s.calibration_docs)
    by_label = {v: [i for i, w in ids if w == v] for v in (0, 1)}
    if not by_label[0] or not by_label[1]:
        return 0.5 if not ids else float(bool(by_label[1]))
    cut = {v: min(s.dictionary_docs, max(1, len(x) // 2)) for v, x in by_label.items()}
    teach = [(i, v) for v, x in by_label.items() for i in x[: cut[v]]]
    check = [(i, v) for v, x in by_label.items() for i in x[cut[v] :]] or teach

    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("blocks", pa.list_(pa.binary()))])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            rows = []
            for t in texts:
                blocks = _blocks(t.encode("utf-8", "replace"), s.block_bytes)
                at = np.unique(np.linspace(0, len(blocks) - 1, s.blocks_per_doc).astype(int)) if blocks else []
                rows.append([blocks[k] for k in at])
            yield to_batch(schema, part.column("doc_id"), part.column("label"), rows)

    taught = _sampled(docs, teach).mapInArrow(spread, "doc_id bigint, label int, blocks array<binary>")
    rows = taught.groupBy("doc_id", "label").agg(F.min("blocks").alias("blocks")).orderBy("doc_id").collect()
    text = {v: [bytes(b) for r in rows if r.label == v for b in r.blocks] for v in (0, 1)}
    if not any(text[0]) or not any(text[1]):
        return 0.5
    good, bad, raw = train_dictionaries(text[1], text[0], s.dictionary_bytes)
    model = Model(good, bad, raw, 0.0, 0.0, s.block_bytes, s.level)
    gains = (
        _sampled(docs, check)
        .mapInArrow(_gains(model, "label"), "label int, doc_id bigint, gain double")
        .groupBy("doc_id", "label").agg(F.min("gain").alias("gain")).collect()
    )
    if not gains:
        return 0.5
    slope, offset = fit_logistic(np.array([r.gain for r in gains]), np.array([r.label for r in gains], dtype=float))
    return Model(good, bad, raw, slope, offset, s.block_bytes, s.level)


def _gains(model: Model, kept: str):
    schema = pa.schema([(kept, pa.int32()), ("doc_id", pa.int64()), ("gain", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = Gain(model)
        for part, texts in text_slices(batches):
            yield to_batch(schema, part.column(kept), part.column("doc_id"), [gain(t) for t in texts])

    return run


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """All columns of ``docs`` and score double, predicted int, from the text alone.

    A null or empty text has gain 0 and the score the curve gives there. Repeated rows get the same score each. A column of
    ``docs`` named score or predicted is replaced. An empty table gives an empty table.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*rest)
    if isinstance(model, float):
        return docs.withColumn("score", F.lit(model)).withColumn("predicted", F.lit(int(model >= 0.5)))

    def probability(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = Gain(model)
        for part, texts in text_slices(batches):
            x = np.array([gain(t) for t in texts], dtype=float) * model.slope + model.offset
            p = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
            kept = [part.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*rest, "score", "predicted"])

    return docs.mapInArrow(probability, wider(docs, score="double", predicted="int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", sampling: Sampling | None = None) -> DataFrame:
    """Fit on labelled rows that are not held out, then score every row."""
    return score(docs, fit(docs, labels, label, sampling))
