"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``bits`` bits, the cells are numbered along a Hilbert curve, and the rows in curve order are cut into
runs. Neighbours on the curve are neighbours in every dimension, so that a shard covers a small box of the metadata space and the
ranges kept per shard let a reader skip shards in any of the dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import stored, wider

BITS = 8
_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits


def of_category(value: Column) -> Column:
    """Cell of a category: its hash, stable however the data is dealt; null is cell 0."""
    return F.when(value.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(value), F.lit((1 << BITS) - 1))).cast("int")


def of_size(value: Column) -> Column:
    """Cell of a size: sixteen steps from one power of two to the next, up to 2^16 and more; null is cell 0."""
    return F.coalesce(F.least(F.lit((1 << BITS) - 1), F.floor(16 * F.log2(1 + F.greatest(value, F.lit(0))))), F.lit(0)).cast("int")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of points with integer coordinates, one column per dimension (at most 62 bits in all)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level
        low = q - 1
        for i in range(dims):
            set_here = (x[i] & q) > 0
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_here, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        fix ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= fix
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve(frame: DataFrame, cells: list[str], name: str = "curve") -> DataFrame:
    """``frame`` with the curve index of its integer columns ``cells``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cells])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_index(points, BITS))], names=[*batch.schema.names, name])

    return frame.mapInArrow(run, wider(frame, **{name: "bigint"}))


def ranked(frame: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """``frame`` with each row's place, from 0, in the order of ``order``: a range partitioned sort and one count per partition."""
    laid = frame.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    table = stored(laid, "ranked").withColumn("_p", F.shiftright("_m", _ROW_BITS))
    counts = sorted((r["_p"], r["n"]) for r in table.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for part, n in counts:
        starts.append((part, before))
        before += n
    offsets = table.sparkSession.createDataFrame(starts or [(0, 0)], "_p bigint, _before bigint")
    row = F.col("_m").bitwiseAND((1 << _ROW_BITS) - 1)
    return table.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_before") + row).drop("_p", "_m", "_before")


def _runs(total: int, count: int) -> tuple[Column, Column]:
    """Shard of a row by its rank, and the rank at which the shard begins: ceil(shard * total / count). Decimals, so that no product overflows."""
    shard = F.expr(f"CAST(CAST(rank AS DECIMAL(20, 0)) * {count} div {max(1, total)} AS INT)")
    return shard, F.expr(f"(CAST(shard AS DECIMAL(20, 0)) * {total} + {count - 1}) div {count}")


def shards(docs: DataFrame, count: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, lang, source, curve, law, shard, slot, grown_shard: shards of row numbers at most one apart.

    The law is ``rows``. Dimensions are language, source and text size; rows in one cell follow by doc_id, then by hash of the text.
    size is the UTF-8 bytes of the text (null: none) plus 1. slot counts from 0 in each shard, in curve order. Equal rows are
    interchangeable. With fewer rows than shards the first shards get one row each; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), "lang", "source",
        of_category(F.col("lang")).alias("_c0"), of_category(F.col("source")).alias("_c1"), of_size(F.octet_length(text)).alias("_c2"),
    )
    placed = ranked(curve(slim, ["_c0", "_c1", "_c2"]), ["curve", "doc_id", "text_crc32", "size"])
    total = placed.count()
    shard, begin = _runs(total, count)
    return placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - begin).select(
        "doc_id", "size", "text_crc32", "lang", "source", "curve", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, count: int = 8) -> DataFrame:
    """Writes ``docs`` as Parquet under path/shard=k in curve order and returns, per shard, rows and the range of every dimension.

    Sizes differ by one row at most, whatever rows are repeated or lack an id: every single row is ranked, texts and all, and keeps its place
    (columns curve and slot) to the written file. A reader prunes shards with the table, and row groups inside a shard by Parquet's own
    ranges, since rows follow the curve. An empty table writes no shard.
    """
    text = F.coalesce("text", F.lit(""))
    rest = [c for c in docs.columns if c not in ("curve", "shard", "slot")]
    order = {"_size": (F.octet_length(text) + 1).cast("bigint"), "_crc": F.crc32(text)}
    cells = {"_c0": of_category(F.col("lang")), "_c1": of_category(F.col("source")), "_c2": of_size(F.octet_length(text))}
    packed = docs.select(F.struct(*rest).alias("_row"), F.col("doc_id").alias("_id"), *[c.alias(n) for n, c in (order | cells).items()])
    placed = ranked(curve(packed, list(cells)), ["curve", "_id", "_crc", "_size"])
    total = placed.count()
    shard, begin = _runs(total, count)
    laid = placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - begin).select("_row.*", "curve", "shard", "slot")
    laid.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    if not total:
        return laid.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    written = docs.sparkSession.read.parquet(path)
    ranges = [f(c).alias(f"{n}_{c}") for c in ("lang", "source", "doc_id") for n, f in (("min", F.min), ("max", F.max))]
    return written.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.min(F.octet_length("text")).alias("min_size"), F.max(F.octet_length("text")).alias("max_size"), *ranges)
