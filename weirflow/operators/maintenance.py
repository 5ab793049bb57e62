"""Maintenance of partitioned parquet tables in the catalog.

Tables are external (``LOCATION`` given), so a fresh staging folder can be used
for every rewrite and only touched partitions are replaced, through dynamic
partition overwrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.session import scratch_path

DETACHED = "_detached"


def with_month(df: DataFrame, date_col: str, name: str = "yyyymm") -> DataFrame:
    return df.withColumn(name, F.date_format(date_col, "yyyyMM"))


def create_partitioned(df: DataFrame, table: str, path: str, partition: str, order: Sequence[str]) -> DataFrame:
    """Create ``table`` from ``df``: folder per partition value, files sorted by ``order``.

    Rows are range-split by (partition, order): a partition that holds a large
    share of the rows is written by several tasks, each with its own key range.
    """
    laid_out(df, [partition], order).write.format("parquet").partitionBy(partition).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def laid_out(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(*partition, *order).sortWithinPartitions(*partition, *order)


def insert(df: DataFrame, table: str) -> None:
    """Append a batch; it becomes new files (parts) of the partitions it touches."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table)


def list_parts(spark: SparkSession, table: str, partition: str) -> DataFrame:
    """One row per data file: partition value, file name, rows; all listed parts are active."""
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return (
        spark.table(table)
        .groupBy(F.lit(table).alias("table"), F.col(partition).alias("partition"), file.alias("name"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("active", F.lit(True))
    )


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of the rows without a partition value


def _spec(partition: str, value) -> str:
    if value is None:
        return f"{partition}=null"
    quoted = str(value).replace("'", "\\'")
    return f"{partition}='{quoted}'"


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _folder(spark: SparkSession, partition: str, value) -> str:
    if value is None:
        return f"{partition}={NULL_FOLDER}"
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
    return f"{partition}={escaped}"


def _overwrite(spark: SparkSession, table: str, rows: DataFrame, order: Sequence[str], partition: str) -> set:
    """Replace exactly the partitions present in ``rows`` and tell which those are.

    Goes through a staging folder, because ``rows`` usually reads the table.
    """
    stage = scratch_path(spark, "stage")
    rows.write.parquet(stage)
    staged = spark.read.schema(rows.schema).parquet(stage).select(*spark.table(table).columns)
    written = {r[0] for r in staged.select(partition).distinct().collect()}  # one value per folder
    if not written:
        return written
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        laid_out(staged, [partition], order).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    spark.catalog.refreshTable(table)
    fs, folder = _fs(spark, stage)
    fs.delete(folder, True)
    return written


def _in(partition: str, values: list) -> Column:
    """Rows of these partition values, the null partition included."""
    known = F.col(partition).isin([v for v in values if v is not None])
    return known | F.col(partition).isNull() if None in values else known


def compact(
    spark: SparkSession, table: str, partition: str, order: Sequence[str], value=None, merge: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Rewrite one partition (or all) into few sorted files; ``merge`` applies a merge rule on the way."""
    rows = spark.table(table)
    rows = rows if value is None else rows.where(F.col(partition) == F.lit(value))
    before = [r[0] for r in rows.select(partition).distinct().collect()]
    written = _overwrite(spark, table, merge(rows) if merge else rows, order, partition)
    _drop_emptied(spark, table, partition, before, written)


def _drop_emptied(spark: SparkSession, table: str, partition: str, before: list, written: set) -> None:
    """Partitions that lost their last row: an overwrite by content leaves them untouched."""
    for v in before:
        if v not in written:
            drop_partition(spark, table, partition, v)


def detach_partition(spark: SparkSession, table: str, partition: str, value) -> None:
    """Set a partition aside: its folder moves under ``_detached``, which reads ignore."""
    base, folder = _location(spark, table), _folder(spark, partition, value)
    fs, source = _fs(spark, f"{base}/{folder}")
    _, aside = _fs(spark, f"{base}/{DETACHED}")
    fs.mkdirs(aside)
    if not fs.rename(source, _fs(spark, f"{base}/{DETACHED}/{folder}")[1]):
        raise OSError(f"cannot detach {folder} of {table}")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(partition, value)})")
    spark.catalog.refreshTable(table)


def attach_partition(spark: SparkSession, table: str, partition: str, value) -> None:
    base, folder = _location(spark, table), _folder(spark, partition, value)
    fs, aside = _fs(spark, f"{base}/{DETACHED}/{folder}")
    _, target = _fs(spark, f"{base}/{folder}")
    if not fs.exists(aside):
        raise OSError(f"nothing detached as {folder} of {table}")
    if fs.exists(target):  # rows came in meanwhile: their files stay and the detached ones join them
        mark = uuid.uuid4().hex
        for status in fs.listStatus(aside):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if not fs.rename(status.getPath(), _fs(spark, f"{base}/{folder}/attached-{mark}-{name}")[1]):
                raise OSError(f"cannot attach {name} of {table}")
        fs.delete(aside, True)
    elif not fs.rename(aside, target):
        raise OSError(f"cannot attach {folder} of {table}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(partition, value)})")
    spark.catalog.refreshTable(table)


def drop_partition(spark: SparkSession, table: str, partition: str, value) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(partition, value)})")
    fs, folder = _fs(spark, f"{_location(spark, table)}/{_folder(spark, partition, value)}")
    if fs.exists(folder):
        fs.delete(folder, True)
    spark.catalog.refreshTable(table)


def replace_partition_from(spark: SparkSession, table: str, source: str, partition: str, value, order: Sequence[str]) -> None:
    """Copy one partition of ``source`` over the same partition of ``table``; the source keeps its rows."""
    rows = spark.table(source).where(F.col(partition) == F.lit(value))
    _overwrite(spark, table, rows, order, partition)


def updated(df: DataFrame, assignments: dict[str, Column], condition: Column) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()})


def deleted(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; unknown counts as not true."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def _touched(spark: SparkSession, table: str, partition: str, condition: Column) -> list:
    # at most one value per partition folder
    return [r[0] for r in spark.table(table).where(condition).select(partition).distinct().collect()]


def mutate_update(spark: SparkSession, table: str, partition: str, order: Sequence[str], assignments: dict[str, Column], condition: Column) -> None:
    """Update in place; the partition column itself cannot be assigned, since rows would have to change folders."""
    if partition in assignments:
        raise ValueError(f"{partition} is the partition column of {table} and cannot be updated")
    values = _touched(spark, table, partition, condition)
    if values:
        rows = spark.table(table).where(_in(partition, values))
        _overwrite(spark, table, updated(rows, assignments, condition), order, partition)


def mutate_delete(spark: SparkSession, table: str, partition: str, order: Sequence[str], condition: Column) -> None:
    values = _touched(spark, table, partition, condition)
    if not values:
        return
    rows = deleted(spark.table(table).where(_in(partition, values)), condition)
    written = _overwrite(spark, table, rows, order, partition)
    _drop_emptied(spark, table, partition, values, written)


def add_column(spark: SparkSession, table: str, name: str, kind: str, default: str | None = None) -> None:
    """Metadata only; old files give the default on read."""
    clause = f" DEFAULT {default}" if default is not None else ""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {kind}{clause})")


def _declared(field) -> str:
    """Column of a CREATE TABLE with its default and comment."""
    default = field.metadata.get("CURRENT_DEFAULT")
    comment = field.metadata.get("comment", "").replace("\\", "\\\\").replace("'", "\\'")
    return f"`{field.name}` {field.dataType.simpleString()}" + (f" DEFAULT {default}" if default else "") + (f" COMMENT '{comment}'" if comment else "")


def drop_column(spark: SparkSession, table: str, name: str, partition: str, order: Sequence[str] = ()) -> None:
    """Remove a column and its data; defaults and comments of the others stay.

    The rows are written once, as they read now, to a folder beside the old one, so that a column added later under the same name
    starts empty.  The table that reads it is complete before it takes the place of the old one (``finish_rewrite``).
    """
    finish_rewrite(spark, table)
    base = _location(spark, table)
    fields = [f for f in spark.table(table).schema if f.name != name]
    beside = f"{base}-{uuid.uuid4().hex}"
    laid_out(spark.table(table).drop(name), [partition], order or [fields[0].name]).write.partitionBy(partition).parquet(beside)
    new = f"{table}{NEW}"
    spark.sql(f"CREATE TABLE {new} ({', '.join(map(_declared, fields))}) USING parquet PARTITIONED BY ({partition}) LOCATION '{beside}'")
    spark.sql(f"ALTER TABLE {new} RECOVER PARTITIONS")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{OLD}")
    finish_rewrite(spark, table)


NEW, OLD = "__new", "__old"


def finish_rewrite(spark: SparkSession, table: str) -> None:
    """Bring a rewrite to its end, also one that broke off.

    A rewritten table waits under the name with ``NEW`` until the one it replaces has been renamed to the name with ``OLD``.  Broken off
    before that renaming, the old table is in place and the new one goes; after it, the new one takes the name and the old one goes.
    Detached partitions move along.  Nothing to do when neither name exists.
    """
    new, old, has = f"{table}{NEW}", f"{table}{OLD}", spark.catalog.tableExists
    if has(new) and has(table):
        _discard(spark, new)
    elif has(new):
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    if has(old) and has(table):
        fs, aside = _fs(spark, f"{_location(spark, old)}/{DETACHED}")
        _, target = _fs(spark, f"{_location(spark, table)}/{DETACHED}")
        if fs.exists(aside) and not fs.rename(aside, target):
            raise OSError(f"cannot move the detached partitions of {table}")
        _discard(spark, old)


def _discard(spark: SparkSession, table: str) -> None:
    fs, folder = _fs(spark, _location(spark, table))
    fs.delete(folder, True)
    spark.sql(f"DROP TABLE {table}")


def comment_column(spark: SparkSession, table: str, name: str, comment: str) -> None:
    quoted = comment.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} ALTER COLUMN {name} COMMENT '{quoted}'")


def rename_table(spark: SparkSession, table: str, new_name: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {new_name}")


def cleared_column(df: DataFrame, column: str, partition: str, value, default=None) -> DataFrame:
    """Reset a column to its default in one partition."""
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(F.col(partition) == F.lit(value), F.lit(default).cast(kind)).otherwise(F.col(column)))


def clear_column_in_partition(spark: SparkSession, table: str, partition: str, value, column: str, order: Sequence[str], default=None) -> None:
    rows = spark.table(table).where(F.col(partition) == F.lit(value))
    _overwrite(spark, table, cleared_column(rows, column, partition, value, default), order, partition)


def ttl_expire(df: DataFrame, ts: str, as_of: Column, row_ttl: Column | None = None, column_ttl: dict[str, tuple[Column, object]] | None = None) -> DataFrame:
    """Rows older than ``row_ttl`` at ``as_of`` go; columns older than their own ttl are reset."""
    out = df
    if row_ttl is not None:
        out = out.where(F.col(ts) + row_ttl > as_of)
    for c, (ttl, default) in (column_ttl or {}).items():
        out = out.withColumn(c, F.when(F.col(ts) + ttl > as_of, F.col(c)).otherwise(F.lit(default).cast(df.schema[c].dataType)))
    return out


def sample_by_hash(df: DataFrame, key: str, parts: int, keep: int) -> DataFrame:
    """Deterministic sample: keys whose md5 prefix falls in the first ``keep`` of ``parts`` slots."""
    slot = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % parts
    return df.where(slot < keep)


def key_range_read(spark: SparkSession, path: str, key: str, low, high) -> DataFrame:
    """Rows with ``low <= key < high`` from a table laid out by ``key``; file statistics skip the rest."""
    return spark.read.parquet(path).where((F.col(key) >= F.lit(low)) & (F.col(key) < F.lit(high)))


def write_sorted(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Range-split and sorted files, so that each file covers a narrow key range."""
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    ranged.sortWithinPartitions(key).write.parquet(path)
