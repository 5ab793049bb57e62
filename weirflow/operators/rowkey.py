"""Row-key tables as long cell frames ``(rowkey, family, qualifier, ts, value)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ["rowkey", "family", "qualifier", "ts", "value"]
CELL_KEY = ["rowkey", "family", "qualifier"]
LONG_MAX = 9223372036854775807


def to_cells(df: DataFrame, rowkey: Column | str, ts: Column | str, columns: Sequence[str], family: str = "cf") -> DataFrame:
    """One cell per listed column; null columns give no cell."""
    key = F.col(rowkey) if isinstance(rowkey, str) else rowkey
    at = F.col(ts) if isinstance(ts, str) else ts
    pairs = F.array(*[F.struct(F.lit(c).alias("q"), F.col(c).cast("string").alias("v")) for c in columns])
    out = df.select(key.alias("rowkey"), at.alias("ts"), F.explode(pairs).alias("c"))
    return out.where("c.v is not null").select(
        "rowkey", F.lit(family).alias("family"), F.col("c.q").alias("qualifier"), "ts", F.col("c.v").alias("value")
    )


def cells_put(existing: DataFrame | None, puts: DataFrame) -> DataFrame:
    """Table after the puts: the newest timestamp of every cell wins, the larger value on equal times."""
    both = puts if existing is None else existing.unionByName(puts)
    newest = F.max(F.struct("ts", "value")).alias("c")
    return both.groupBy(*CELL_KEY).agg(newest).select(*CELL_KEY, "c.ts", "c.value")


def wide(cells: DataFrame, columns: Sequence[str], families: Sequence[str] | None = None) -> DataFrame:
    """One row per row key with the newest value of the listed columns."""
    kept = cells.where(F.col("qualifier").isin(list(columns)))
    if families:
        kept = kept.where(F.col("family").isin(list(families)))
    cols = [F.max_by("value", F.when(F.col("qualifier") == c, F.struct("ts", "value"))).alias(c) for c in columns]
    return kept.groupBy("rowkey").agg(*cols)


def row_get(cells: DataFrame, rowkey: str | Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Cells of one row, all columns or the listed ones; both filters reach the scan."""
    out = cells.where(F.col("rowkey") == rowkey)
    return out if columns is None else out.where(F.col("qualifier").isin(list(columns)))


def prefix_stop(prefix: str) -> str | None:
    """Smallest string above every string that starts with ``prefix``."""
    for i in range(len(prefix) - 1, -1, -1):
        if ord(prefix[i]) < 0x10FFFF:
            return prefix[:i] + chr(0xE000 if ord(prefix[i]) == 0xD7FF else ord(prefix[i]) + 1)
    return None


def prefix_predicate(prefix: str, key: str = "rowkey") -> Column:
    """A prefix as a range, which file and partition statistics can prune."""
    stop = prefix_stop(prefix)
    low = F.col(key) >= prefix
    return low if stop is None else low & (F.col(key) < stop)


def scan_prefix(cells: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    out = cells.where(prefix_predicate(prefix))
    return out if columns is None else out.where(F.col("qualifier").isin(list(columns)))


def scan_range(cells: DataFrame, start: str | None = None, stop: str | None = None) -> DataFrame:
    """``start <= rowkey < stop``; a missing bound is open.  Spark compares strings by their UTF-8 bytes."""
    out = cells
    if start is not None:
        out = out.where(F.col("rowkey") >= start)
    if stop is not None:
        out = out.where(F.col("rowkey") < stop)
    return out


def column_equals(column: str, value: str, filter_if_missing: bool = False) -> Column:
    """Column filter on the wide view; rows lacking the column pass unless told otherwise."""
    return F.coalesce(F.col(column) == value, F.lit(not filter_if_missing))


def scan_filter_list(wide_rows: DataFrame, filters: Sequence[Column], must_pass_all: bool = True) -> DataFrame:
    combine = (lambda a, b: a & b) if must_pass_all else (lambda a, b: a | b)
    return wide_rows.where(reduce(combine, filters))


def row_delete(cells: DataFrame, rowkey: str | None = None, prefix: str | None = None, cell: tuple[str, str, str] | None = None) -> DataFrame:
    """Table without one row, all rows of a prefix, or one cell (row key, family, qualifier)."""
    out = cells
    if rowkey is not None:
        out = out.where(F.col("rowkey") != rowkey)
    if prefix is not None:
        out = out.where(~prefix_predicate(prefix))
    if cell is not None:
        k, f, q = cell
        out = out.where(~((F.col("rowkey") == k) & (F.col("family") == f) & (F.col("qualifier") == q)))
    return out


def row_values_joined(cells: DataFrame, sep: str = "_") -> DataFrame:
    """Row key and its values in qualifier order, joined; a row has as many values as it has columns."""
    newest = cells_put(None, cells)
    sorted_cells = F.array_sort(F.collect_list(F.struct("family", "qualifier", "value")))
    return newest.groupBy("rowkey").agg(
        F.array_join(F.transform(sorted_cells, lambda c: c["value"]), sep).alias("row_values")
    )


def values_joined(wide_rows: DataFrame, columns: Sequence[str], sep: str = "_", name: str = "row_values") -> DataFrame:
    """The wide view with the values of its ``columns`` joined in qualifier order; missing ones are left out."""
    return wide_rows.withColumn(name, F.concat_ws(sep, *[F.col(c) for c in sorted(columns)]))


def reverse_time_rowkey(key: Column | str, ts: Column) -> Column:
    """``key-(max long - epoch ms)``, zero padded to 19 digits: newest row of a key first in byte order."""
    k = F.col(key) if isinstance(key, str) else key
    left = F.lit(LONG_MAX) - F.unix_millis(ts.cast("timestamp"))
    return F.concat(k.cast("string"), F.lit("-"), F.lpad(left.cast("string"), 19, "0"))


def reverse_time_bounds(key: str, from_ms: int, to_ms: int) -> tuple[str, str]:
    """Row-key range holding the times ``(from_ms, to_ms]`` of one key."""
    return f"{key}-{LONG_MAX - to_ms:019d}", f"{key}-{LONG_MAX - from_ms:019d}"


VALUE_MARK = "="
CSV_AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"', "maxCharsPerColumn": "-1"}


def pack_record(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "packed") -> DataFrame:
    """Many columns in one binary column, values only: smaller to store, but not filterable.

    Fields are length-free CSV in column order, so names are not repeated per row.
    A value has a mark before it and null has none, so blanks, empty texts and nulls all come back as they were.
    """
    fields = F.struct(*[F.concat(F.lit(VALUE_MARK), F.col(c).cast("string")).alias(c) for c in columns])
    return df.select(*keys, F.encode(F.to_csv(fields, CSV_AS_IS), "UTF-8").alias(name))


def unpack_record(df: DataFrame, columns: Sequence[str], name: str = "packed") -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    keys = [c for c in df.columns if c != name]
    out = df.select(*keys, F.from_csv(F.decode(name, "UTF-8"), schema, CSV_AS_IS).alias("r"))
    return out.select(*keys, *[F.expr(f"substring(r.`{c}`, 2)").alias(c) for c in columns])


def table_copy(source: DataFrame, target: str) -> None:
    """Batch copy of a cell table to another table folder, laid out by row key."""
    laid_out_by_key(source).write.mode("overwrite").parquet(target)


def laid_out_by_key(cells: DataFrame, splits: int | None = None) -> DataFrame:
    ranged = cells.repartitionByRange(splits, "rowkey", "qualifier") if splits else cells.repartitionByRange("rowkey", "qualifier")
    return ranged.sortWithinPartitions("rowkey", "qualifier")


def write_splits(cells: DataFrame, path: str, splits: int | None = None) -> None:
    """Store a table as key ranges, one sorted file per split; as many as the size of the table asks for when not given."""
    laid_out_by_key(cells, splits).write.parquet(path)


def split_scan(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Parallel scan of a stored table; splits outside ``[start, stop)`` are skipped by their statistics."""
    return scan_range(spark.read.parquet(path), start, stop)


def messages_to_rows(df: DataFrame, ts: str, seq: str, value: str) -> DataFrame:
    """Row keyed by arrival second; a later message of the same second overwrites the earlier one."""
    key = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return df.groupBy(key.alias("rowkey")).agg(F.max_by(value, seq).alias("value"))


def create_table(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(
        f"CREATE TABLE {table} (rowkey string, family string, qualifier string, ts bigint, value string) "
        f"USING parquet LOCATION '{path}'"
    )


def truncate_table(spark: SparkSession, table: str) -> None:
    """Empty the table; its definition stays."""
    spark.createDataFrame([], spark.table(table).schema).write.insertInto(table, overwrite=True)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop the table and its files, also where it was created over a given path."""
    if not spark.catalog.tableExists(table):
        return
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE {table}")
    for r in rows:
        folder = spark._jvm.org.apache.hadoop.fs.Path(r["data_type"])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)
