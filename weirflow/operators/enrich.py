"""Lookups against static, refreshed and changing dimensions.

No join is forced to broadcast: Spark broadcasts a dimension when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
splitting hot keys (AQE skew join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.ordering import latest, ordered

# The texts answers carry.
NOT_FOUND = "not found"
NOT_FOUND_CITY = "not found city"
LOADED = "加载完毕..."


def lookup_static(
    facts: DataFrame, dim: DataFrame, on: str, dim_key: str, value: str, default: str = NOT_FOUND, name: str = "label", dim_seq: str | None = None
) -> DataFrame:
    """Left join with a default; keys are compared as given (cast both sides to int for ids like ``001``).

    A key that the dimension has twice gives its last value by ``dim_seq``, or the greatest one without it, never two rows.
    """
    last = F.max(value) if dim_seq is None else F.max_by(value, dim_seq)
    d = dim.groupBy(F.col(dim_key).alias("_wf_k")).agg(last.alias("_wf_v"))
    out = facts.join(d, facts[on] == F.col("_wf_k"), "left")
    return out.withColumn(name, F.coalesce(F.col("_wf_v"), F.lit(default))).drop("_wf_k", "_wf_v")


def read_dimension(spark, path: str, sep: str = " ", names: tuple[str, str] = ("id", "label")) -> DataFrame:
    """Two-column text dimension; an id is compared as an integer, so ``001`` equals 1."""
    parts = F.split("value", sep, 2)
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(parts[0].cast("int").alias(names[0]), F.trim(parts[1]).alias(names[1]))


def lookup_config_stream(
    events: DataFrame, config: DataFrame, key: str, seq: str, config_key: str, config_seq: str, value: str, default: str = NOT_FOUND_CITY, name: str = "label"
) -> DataFrame:
    """As-of lookup: the newest config row of the key with ``config_seq <= seq``.

    Events and config are one ordered sequence per key; the value is carried
    forward with a block scan, so no pairs are formed and hot keys are split.
    """
    e = events.withColumns({"_wf_v": F.lit(None).cast("string"), "_wf_event": F.lit(1)})
    c = config.select(
        F.col(config_key).alias(key), F.col(config_seq).alias(seq), F.col(value).cast("string").alias("_wf_v"), F.lit(0).alias("_wf_event")
    )
    both = e.unionByName(c, allowMissingColumns=True)
    run = ordered(both, [key], [seq, "_wf_event"]).scan(_wf_now=latest("_wf_v")).frame
    found = F.coalesce(F.nullif(F.col("_wf_now"), F.lit("")), F.lit(default))
    return run.where("_wf_event = 1").withColumn(name, found).select(*events.columns, name)


def lookup_connected(
    events: DataFrame, config: DataFrame, key: str, seq: str, config_key: str, config_seq: str, value: str, default: str = NOT_FOUND, name: str = "answer"
) -> DataFrame:
    """Answers for lookups plus one acknowledgement per config row, with ``side`` 1 or 2."""
    answers = lookup_config_stream(events, config, key, seq, config_key, config_seq, value, default, name)
    ack = F.concat(F.col(config_key).cast("string"), F.lit(" "), F.col(value).cast("string"), F.lit(LOADED))
    return answers.select(F.lit(1).alias("side"), F.col(seq).alias("seq"), name).unionByName(
        config.select(F.lit(2).alias("side"), F.col(config_seq).alias("seq"), ack.alias(name))
    )
