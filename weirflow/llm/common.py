"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.session import scratch_path

SLICE_BYTES = 8 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast where its counted ``rows`` of a few numbers are within the bound; else left to a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def by_shuffle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for a shuffle join; where its counted ``rows`` of a few numbers are within the bound, Spark may choose.

    Spark sizes rows of an explode or of Python by the rows they come from, and files by their compressed bytes. Left to choose, it sends
    tables by way of the driver that are many times its limit.
    """
    return df if rows is not None and rows <= BROADCAST_ROWS else df.hint("merge")


PAGE_BITS, PAGES = 1 << 15, 1 << 14


def marked(df: DataFrame, wanted: DataFrame, on: list[str], name: str) -> DataFrame:
    """``df`` with the boolean column ``name``: true for all rows whose ``on`` is in ``wanted``, and for a few others.

    ``wanted`` becomes a bitmap of 16 to 32 bits a row, at most PAGES * PAGE_BITS / 8 bytes (64 MB), which is broadcast in pages. Beyond 2^25
    rows it lets ever more of the others pass. Null counts as a value.
    """
    pages = min(PAGES, 1 << (16 * wanted.count() // PAGE_BITS).bit_length())
    cell = F.pmod(F.xxhash64(*on), F.lit(pages * PAGE_BITS))
    page, bit = (cell / PAGE_BITS).cast("int"), (cell % PAGE_BITS).cast("bigint")
    marks = wanted.select(page.alias("_wf_page"), bit.alias("_wf_bit")).groupBy("_wf_page").agg(F.bitmap_construct_agg("_wf_bit").alias("_wf_marks"))
    placed = df.select("*", page.alias("_wf_page"), bit.alias("_wf_bit")).join(F.broadcast(marks), "_wf_page", "left")
    byte = "CAST(conv(hex(substring(_wf_marks, CAST(_wf_bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return placed.select(*df.columns, F.expr(f"coalesce(getbit({byte}, CAST(_wf_bit % 8 AS INT)) = 1, false)").alias(name))


def within(df: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``wanted``, and a few others: what a later join on ``on`` would drop need not be shuffled to it."""
    return marked(df, wanted, on, "_wf_in").where("_wf_in").select(*df.columns)


def held_out(doc_id: str | Column) -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 1 modulo 3; a null id is held out too."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(True))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Key of a row that is the same for repeated rows and differs between texts under one id; never null."""
    return F.struct(F.coalesce(F.col(doc_id), F.lit(-1)).alias("i"), F.col(doc_id).isNull().alias("z"), F.xxhash64(text).alias("h"))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` with about ``limit`` bytes of text each, at least one row."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Small batches with their texts as a list; a null text is the empty text. Gives memory back when the task ends."""
    try:
        for batch in batches:
            for a, b in slices(batch, limit=limit):
                part = batch.slice(a, b - a)
                yield part, ["" if t is None else t for t in part.column("text").to_pylist()]
    finally:
        batch = part = None
        free_memory()


def byte_slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """As ``text_slices``, with the texts as UTF-8 and no strings made of them."""
    try:
        for batch in batches:
            for a, b in slices(batch, limit=limit):
                part = batch.slice(a, b - a)
                yield part, part.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
    finally:
        batch = part = None
        free_memory()


def free_memory() -> None:
    """Workers wait for their next task with what the allocators kept of this one; hand that back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def wider(df: DataFrame, **added: str) -> T.StructType:
    """Schema of ``df`` with more columns, given as name=type."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added.items())).fields])
