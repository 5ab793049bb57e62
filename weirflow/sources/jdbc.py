"""Tables of a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """One table.  With a numeric ``partition_column`` it is read in parallel; filters are pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column:
        if not (bounds and partitions):
            raise ValueError("a partitioned read needs bounds and the number of partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**(properties or {})).load()


def jdbc_read_schema(spark: SparkSession, url: str, schema: str, properties: dict[str, str] | None = None, catalog_query: str | None = None) -> dict[str, DataFrame]:
    """Every table of a database schema, mapped by name and registered as ``<schema>_<table>``."""
    query = catalog_query or f"SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}'"
    names = spark.read.format("jdbc").option("url", url).option("query", query).options(**(properties or {})).load()
    out = {}
    for (name,) in names.collect():
        out[name] = jdbc_read(spark, url, f"{schema}.{name}", properties)
        out[name].createOrReplaceTempView(f"{schema}_{name}")
    return out
