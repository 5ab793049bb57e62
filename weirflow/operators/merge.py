"""Merge semantics for batches of inserted rows.

All merges act inside one partition value, on rows with equal order columns, and
never across partitions.  ``seq`` is the insertion order.  Everything here is an
aggregation with a map-side part: a hot key sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions import states
from weirflow.operators.ordering import row_index


def replacing_latest(df: DataFrame, partition: Sequence[str], order: Sequence[str], seq: str) -> DataFrame:
    """Keep the row inserted last."""
    return _keep_max(df, partition, order, F.col(seq))


def replacing_by_version(df: DataFrame, partition: Sequence[str], order: Sequence[str], version: str, seq: str) -> DataFrame:
    """Keep the row with the largest version; among equals the one inserted last."""
    return _keep_max(df, partition, order, F.struct(version, seq))


def replacing_composite_key(df: DataFrame, partition: Sequence[str], order: Sequence[str], version: str, seq: str) -> DataFrame:
    """Rows replace each other only when *all* order columns agree; a shorter index key plays no part."""
    if len(order) < 2:
        raise ValueError("a composite key needs at least two order columns")
    return replacing_by_version(df, partition, order, version, seq)


def _keep_max(df: DataFrame, partition: Sequence[str], order: Sequence[str], by: Column) -> DataFrame:
    keys = list(dict.fromkeys([*partition, *order]))
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("r"))
    return out.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in df.columns])


def summing_columns(df: DataFrame, partition: Sequence[str], order: Sequence[str], seq: str, columns: Sequence[str]) -> DataFrame:
    """Sum the named columns, keep the first inserted value of the others."""
    keys = list(dict.fromkeys([*partition, *order]))
    rest = [c for c in df.columns if c not in keys and c not in columns]
    out = df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in columns], F.min_by(F.struct(*rest), seq).alias("r")
    )
    return out.select(*[F.col(f"r.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def summing_all_numeric(df: DataFrame, partition: Sequence[str], order: Sequence[str], seq: str) -> DataFrame:
    """Sum every numeric column that is neither key nor insertion order."""
    keys = {*partition, *order, seq}
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return summing_columns(df, partition, order, seq, numeric)


def aggregating_merge(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], seq: str, state_columns: dict[str, str]
) -> DataFrame:
    """Merge stored aggregate states (name -> state kind); other columns keep their first value."""
    keys = list(dict.fromkeys([*partition, *order]))
    state_names = [c for n, kind in state_columns.items() for c in states.columns(kind, n)]
    rest = [c for c in df.columns if c not in keys and c not in state_names]
    merged = [c for n, kind in state_columns.items() for c in states.merge(kind, n)]
    out = df.groupBy(*keys).agg(*merged, F.min_by(F.struct(*rest), seq).alias("r"))
    return out.select(*[F.col(f"r.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def collapsing(df: DataFrame, partition: Sequence[str], order: Sequence[str], sign: str, seq: str) -> DataFrame:
    """Cancel +1 rows with later -1 rows of the same key.

    equal counts, last row -1   nothing stays
    equal counts, last row +1   first -1 and last +1 stay
    more -1                     first -1 stays
    more +1                     last +1 stays
    """
    keys = list(dict.fromkeys([*partition, *order]))
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    plus, minus = F.col(sign) == 1, F.col(sign) == -1
    g = df.groupBy(*keys).agg(
        F.count_if(plus).alias("p"),
        F.count_if(minus).alias("n"),
        F.max_by(F.col(sign), F.col(seq)).alias("last_sign"),
        F.min_by(row, F.when(minus, F.col(seq))).alias("first_minus"),
        F.max_by(row, F.when(plus, F.col(seq))).alias("last_plus"),
    )
    stay = (
        F.when(F.col("n") > F.col("p"), F.array("first_minus"))
        .when(F.col("p") > F.col("n"), F.array("last_plus"))
        .when(F.col("last_sign") == 1, F.array("first_minus", "last_plus"))
        .otherwise(F.array().cast(df.select(F.array(row)).schema[0].dataType))
    )
    out = g.select(*keys, F.explode(stay).alias("r"))
    return out.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in df.columns])


def versioned_collapsing(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], sign: str, version: str, seq: str
) -> DataFrame:
    """Cancel +1 and -1 rows of the same key and version in any order.

    With k more rows of one sign, k rows of it stay: the last k for +1, the first
    k for -1.  The reference result does not show which rows stay; this is our rule.
    """
    keys = list(dict.fromkeys([*partition, *order, version]))
    counts = df.groupBy(*keys).agg(F.sum(F.col(sign).cast("long")).alias("_wf_net"), F.count_if(F.col(sign) == 1).alias("_wf_p"))
    left = counts.where("_wf_net <> 0").select(*[F.col(k).alias(f"_wf_{k}") for k in keys], "_wf_net", "_wf_p")
    on = F.when(F.col("_wf_net") > 0, 1).otherwise(-1) == F.col(sign)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_wf_{k}"))
    # numbered per sign before the join, so that the input is prepared once
    ranked = row_index(df, [*keys, sign], [seq], "_wf_i").join(left, on).drop(*[f"_wf_{k}" for k in keys])
    stays = F.when(F.col("_wf_net") > 0, F.col("_wf_i") > F.col("_wf_p") - F.col("_wf_net")).otherwise(
        F.col("_wf_i") <= -F.col("_wf_net")
    )
    return ranked.where(stays).select(*df.columns)


def union_tables_regex(spark: SparkSession, pattern: str, database: str | None = None, source: str | None = None) -> DataFrame:
    """All catalog tables and views whose whole name matches ``pattern``, as one read-only frame."""
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    full = {t.name: t.name if t.isTemporary else ".".join(f"`{x}`" for x in [*(t.namespace or []), t.name]) for t in listed}
    rows = spark.createDataFrame([(n,) for n in full] or [("",)], "name string")
    names = sorted(r[0] for r in rows.where(F.col("name").rlike(f"^(?:{pattern})$")).collect() if r[0])
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    out = None
    for n in names:
        df = spark.table(full[n])
        df = df.withColumn(source, F.lit(n)) if source else df
        out = df if out is None else out.unionByName(df)
    return out
