"""Benchmark decontamination by winnowing, in DataFrame expressions only.

A window is ``length`` consecutive words of a benchmark item; an item with fewer words is one window of its own length. Both sides
keep, for every window, the smallest hash of the k-grams inside it (k = GRAM or fewer). Equal windows have equal minima, so the join
of the minima finds every shared window; each hit is then extended to the whole window, word by word (64 bits of hash per word).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import by_shuffle, row_key, stored

GRAM = 5
BROADCAST_WINDOWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def words(text: Column) -> Column:
    """Lower-cased runs of digits, ASCII letters and characters outside ASCII; a null text has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _BREAKS, _LOWER + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def _hashed(frame: DataFrame) -> DataFrame:
    """Adds n, the word hashes h and the hashes g of the GRAM words from each place of words ``w``."""
    sized = frame.withColumn("n", F.size("w")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    gram = f"xxhash64({', '.join(f'get(h, i + {j})' for j in range(GRAM))})"
    return sized.withColumn("g", F.expr(f"CASE WHEN n = 0 THEN array() ELSE transform(sequence(0, n - 1), i -> {gram}) END"))


def _minimum(length: int) -> str:
    """SQL of the smallest k-gram hash of the window of ``length`` words that starts at place ``at``."""
    if length < GRAM:
        return f"xxhash64({', '.join(f'get(h, at + {j})' for j in range(length))})"
    grams = [f"get(g, at + {i})" for i in range(length - GRAM + 1)]
    return f"least({', '.join(grams)})" if len(grams) > 1 else grams[0]


def item_windows(items: DataFrame, length: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows of different windows and items: length, mark (smallest k-gram hash), hashes of the words, item. Items without words have none."""
    tokens = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    starts = _hashed(tokens).withColumn("m", F.least("n", F.lit(length))).withColumn("at", F.explode(F.expr("sequence(0, n - m)")))
    mark = F.expr("CASE m " + " ".join(f"WHEN {m} THEN {_minimum(m)}" for m in range(1, length + 1)) + " END")
    return starts.select(F.col("m").alias("length"), mark.alias("mark"), F.expr("slice(h, at + 1, m)").alias("window"), "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit counts the document's words inside an occurrence of any item window; items_sha256 is over the comma-joined ids, sorted as
    strings, of the items with such windows (of the empty string without any). Null and empty texts have no words. Repeated rows and
    rows with a null id get their own results. Columns of these names in ``docs`` are replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    kept = docs.select(*[c for c in docs.columns if c not in added])
    windows = stored(item_windows(items, length), "windows")
    sizes = sorted(r.length for r in windows.select("length").distinct().collect())
    small = windows.select("length", "mark", "window").distinct().limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    if not sizes:
        none = [F.lit(0).cast("bigint").alias("n_hit"), F.lit(0).cast("bigint").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256")]
        return kept.select("*", F.size(words(F.col(text))).cast("bigint").alias("n_words"), *none, F.lit(False).alias("contaminated"))
    marks = windows.select("length", "mark", "window").distinct()
    # one row more than there are words carries the number of words, so that one reading of the texts gives both
    tokens = _hashed(kept.select(row_key(doc_id, text).alias("k"), words(F.col(text)).alias("w"))).drop("w")
    places = tokens.withColumn("at", F.explode(F.expr("sequence(0, n)")))
    each = ", ".join(f"named_struct('length', {m}, 'mark', CASE WHEN at + {m} <= n THEN {_minimum(m)} END)" for m in sizes)
    last = "array(named_struct('length', 0, 'mark', CAST(NULL AS BIGINT)))"
    starts = places.withColumn("win", F.explode(F.expr(f"CASE WHEN at = n THEN {last} ELSE array({each}) END")))
    found = starts.select("k", "n", "h", "at", F.col("win.length").alias("length"), F.col("win.mark").alias("mark"))
    if small:
        joined = found.where("at = n OR mark IS NOT NULL").join(F.broadcast(marks), ["length", "mark"], "left")
        hits = joined.where("at = n OR (window IS NOT NULL AND slice(h, at + 1, length) = window)").select("k", "n", "at", "length", "window")
    else:  # places are shuffled with the hashes of their own window only, and the rows that carry the number of words not at all
        spans = found.where("mark IS NOT NULL").select("k", "n", "at", "length", "mark", F.expr("slice(h, at + 1, length)").alias("span"))
        hits = spans.join(by_shuffle(marks), ["length", "mark"]).where("span = window").select("k", "n", "at", "length", "window")
        hits = hits.unionByName(tokens.select("k", "n", F.col("n").alias("at"), F.lit(0).alias("length"), F.lit(None).cast("array<bigint>").alias("window")))
    return _summed(kept, stored(hits, "hits"), windows, doc_id, text)


def _summed(kept: DataFrame, hits: DataFrame, windows: DataFrame, doc_id: str, text: str) -> DataFrame:
    spans = hits.groupBy("k", "at").agg(F.max("n").alias("n"), F.max("length").alias("length"))
    places = spans.select("k", "n", F.explode(F.expr("CASE WHEN at = n THEN array(-1) ELSE sequence(at, at + length - 1) END")).alias("at"))
    covered = (
        places.groupBy("k", "at").agg(F.max("n").alias("n"))
        .groupBy("k").agg(F.max("n").cast("bigint").alias("n_words"), F.count(F.when(F.col("at") >= 0, 1)).alias("n_hit"))
    )
    named = hits.where("window IS NOT NULL").select("k", "window").distinct().join(windows.select("window", "item").distinct(), "window")
    ids = named.select("k", F.col("item").cast("string").alias("item")).distinct().groupBy("k").agg(F.sort_array(F.collect_list("item")).alias("ids"))
    both = covered.join(ids, "k", "left").select(
        "k", "n_words", "n_hit", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("ids", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
    return kept.withColumn("_wf_k", row_key(doc_id, text)).join(both.withColumnRenamed("k", "_wf_k"), "_wf_k").drop("_wf_k")
