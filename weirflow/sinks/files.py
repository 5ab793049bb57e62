"""Text, CSV and rolling file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_text(df: DataFrame, path: str, files: int | None = None) -> None:
    """Text files, ``files`` of them when given."""
    (df.repartition(files) if files else df).write.text(path)


def export_csv(df: DataFrame, path: str, sep: str = "|", header: bool = False) -> None:
    df.write.option("sep", sep).option("header", header).csv(path)


def rolling_file_sink(
    df: DataFrame, ts: str, path: str, checkpoint: str, roll_seconds: int = 10, max_rows_per_file: int | None = None, fmt: str = "parquet", available_now: bool = False
) -> StreamingQuery:
    """Files in ``date=/hour=`` folders; a new file per roll interval and at most ``max_rows_per_file`` rows.

    A micro-batch closes its files, so no file stays open longer than the roll
    interval and an idle bucket has no open file.
    """
    bucketed = df.withColumns({"date": F.date_format(ts, "yyyy-MM-dd"), "hour": F.date_format(ts, "HH")})
    writer = (
        bucketed.writeStream.format(fmt)
        .partitionBy("date", "hour")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{roll_seconds} seconds"}
    return writer.trigger(**trigger).start()
