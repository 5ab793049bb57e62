"""Text, CSV and literal sources."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from weirflow.session import ship_package
from weirflow.sources import watched


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one or many text files, column ``value``."""
    return spark.read.text(path)


def read_csv_typed(
    spark: SparkSession, path: str, schema: str, sep: str = ",", view: str | None = None, header: bool = False
) -> DataFrame:
    """CSV with declared names and types (never inferred), optionally registered as ``view``.

    ``path`` may be a glob; all matching files are read as one table.
    """
    df = spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_csv_glob(spark: SparkSession, pattern: str, schema: str, sep: str = ",") -> DataFrame:
    """All files of a glob as one read-only table; write to one concrete path instead of a pattern."""
    return read_csv_typed(spark, pattern, schema, sep)


def from_values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows; for fixtures and small parameters."""
    return spark.createDataFrame(list(rows), schema)


def generate_sequence(spark: SparkSession, first: int, last: int, name: str = "value") -> DataFrame:
    """All integers from ``first`` to ``last``, both included, made in parallel."""
    return spark.range(first, last + 1).toDF(name)


def stream_text_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded lines: every new file of ``folder``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def stream_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket.  Not replayable: rows since the last checkpoint are lost on failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def stream_parquet(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Stream of a parquet table: the files of a folder, or the one file ``path`` names.

    ``files_per_batch`` bounds a micro-batch, and with it what a stateful key can
    get at once.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jvm_path) and fs.getFileStatus(jvm_path).isFile():
        reader = reader.option("pathGlobFilter", jvm_path.getName())
        path = jvm_path.getParent().toString()
    return reader.load(path)


def replay_in_order(df: DataFrame, order: Sequence[str], path: str, slice_rows: int = 2_000_000, least: int = 4) -> str:
    """Lay ``df`` out under ``path`` as one file per slice of ``order``, each younger than the one before.

    A file stream takes files by age, so read with one file per batch the rows arrive in order, however the input was
    split into files.  Slices hold about ``slice_rows`` rows.  Needs a file system with settable times (HDFS and local
    disks have them).
    """
    spark = df.sparkSession
    slices = max(least, -(-df.count() // slice_rows))
    df.repartitionByRange(slices, *order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # written files are numbered by slice
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    first = int(time.time() * 1000) - 1000 * len(names)
    for i, name in enumerate(names):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), first + 1000 * i, -1)
    return path


def stream_follow_file(spark: SparkSession, path: str) -> DataFrame:
    """Unbounded lines: the whole content of ``path`` (a file or a folder) each time it has changed.

    What was seen last is the stream's offset, so a restarted query gives nothing again until the path changes. A batch that is repeated
    after a failure reads the content as it is then, because an overwritten file can't be read as it was.
    """
    watched.register(ship_package(spark))
    return spark.readStream.format(watched.FollowSource.name()).option("path", path).load()
