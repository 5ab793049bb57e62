"""Mergeable aggregate states that can be stored in a table and merged later.

A state named ``x`` is one or two plain columns, so a table of states is an
ordinary table:

sum, count, min, max   one column ``x``
avg                    ``x_s`` (sum) and ``x_n`` (count)
distinct               ``x``, a HyperLogLog sketch (approximate count)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("sum", "count", "min", "max", "avg", "distinct")


def columns(kind: str, name: str) -> list[str]:
    return [f"{name}_s", f"{name}_n"] if kind == "avg" else [name]


def build(kind: str, col: str, name: str) -> list[Column]:
    if kind == "sum":
        return [F.sum(col).alias(name)]
    if kind == "count":
        return [F.count(col).alias(name)]
    if kind == "min":
        return [F.min(col).alias(name)]
    if kind == "max":
        return [F.max(col).alias(name)]
    if kind == "avg":
        return [F.sum(col).alias(f"{name}_s"), F.count(col).alias(f"{name}_n")]
    if kind == "distinct":
        return [F.hll_sketch_agg(col).alias(name)]
    raise ValueError(f"unknown state kind {kind!r}, expected one of {KINDS}")


def merge(kind: str, name: str) -> list[Column]:
    if kind in ("sum", "count"):
        return [F.sum(name).alias(name)]
    if kind == "min":
        return [F.min(name).alias(name)]
    if kind == "max":
        return [F.max(name).alias(name)]
    if kind == "avg":
        return [F.sum(f"{name}_s").alias(f"{name}_s"), F.sum(f"{name}_n").alias(f"{name}_n")]
    if kind == "distinct":
        return [F.hll_union_agg(name).alias(name)]
    raise ValueError(f"unknown state kind {kind!r}, expected one of {KINDS}")


def finish(kind: str, name: str) -> Column:
    if kind == "avg":
        return F.col(f"{name}_s").cast("double") / F.col(f"{name}_n")
    if kind == "distinct":
        return F.hll_sketch_estimate(name)
    return F.col(name)
