"""Time, count and session windows, keyed and un-keyed."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.ordering import ordered, previous, row_index, running_max


def time_window(
    df: DataFrame, ts: str, size: str, aggs: dict[str, Column], keys: Sequence[str] = (), slide: str | None = None, offset: str | None = None
) -> DataFrame:
    """Tumbling or sliding window aggregate with ``window_start`` / ``window_end``.

    Windows are half open and aligned to the epoch (plus ``offset``).  Works on
    streams too; the aggregates combine in the map tasks, so an un-keyed window
    moves one row per task and window.
    """
    w = F.window(ts, size, slide or size, offset) if offset else F.window(ts, size, slide or size)
    out = df.groupBy(*keys, w.alias("_wf_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("_wf_w.start").alias("window_start"), F.col("_wf_w.end").alias("window_end"), *aggs)


def first_word_and_total(df: DataFrame, ts: str, size: str, word: str, seq: str, amount: Column | None = None) -> DataFrame:
    """Un-keyed window: the word seen first and the total of all rows."""
    total = F.count(F.lit(1)) if amount is None else F.sum(amount)
    return time_window(df, ts, size, {"word": F.min_by(word, seq), "total": total})


def pane_micros(size: str, slide: str) -> int:
    """Microseconds of the longest pane that both window lengths are made of."""
    return math.gcd(*(pd.Timedelta(x).value // 1000 for x in (size, slide)))


def sliding_by_panes(
    df: DataFrame, ts: str, size: str, slide: str, partial: dict[str, Column], final: dict[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Sliding window from panes of one slide each.

    Rows are aggregated to panes first (``partial``), only panes are copied into
    the size/slide windows they belong to, then ``final`` combines them.  With
    30 min / 10 s that is 180 copies per pane instead of per row.  Where ``slide``
    does not divide ``size``, panes are as long as their greatest common divisor.
    """
    pane = pane_micros(size, slide)
    panes = df.groupBy(*keys, F.window(ts, f"{pane} microseconds").alias("_wf_p")).agg(*[c.alias(n) for n, c in partial.items()])
    panes = panes.withColumn("_wf_pane", F.col("_wf_p.start")).drop("_wf_p")
    out = panes.groupBy(*keys, F.window("_wf_pane", size, slide).alias("_wf_w")).agg(*[c.alias(n) for n, c in final.items()])
    return out.select(*keys, F.col("_wf_w.start").alias("window_start"), F.col("_wf_w.end").alias("window_end"), *final)


def sliding_avg(df: DataFrame, ts: str, value: str, size: str, slide: str, keys: Sequence[str]) -> DataFrame:
    """Sum, count and average of ``value`` per key and sliding window."""
    out = sliding_by_panes(
        df, ts, size, slide,
        {"_s": F.sum(value), "_n": F.count(value)},
        {"total": F.sum("_s"), "cnt": F.sum("_n")},
        keys,
    )
    return out.withColumn("avg", F.col("total").cast("double") / F.col("cnt"))


def sliding_top_bottom(df: DataFrame, ts: str, key: str, value: str, seq: str, size: str, slide: str) -> DataFrame:
    """Per window: take the last value of each key, report the key with the largest and the smallest one.

    Ties go to the smaller key.  Three reductions, each combined before its shuffle.
    """
    last = sliding_by_panes(
        df, ts, size, slide,
        {"_l": F.max_by(F.struct(F.col(value).alias("v"), F.col(seq).alias("s")), seq)},
        {"v": F.max_by("_l.v", "_l.s")},
        [key],
    )
    top, low = extremes(key)
    out = last.groupBy("window_start", "window_end").agg(top.alias("t"), low.alias("b"))
    return out.select("window_start", "window_end", *named_extremes(key))


def extremes(key: str) -> tuple[Column, Column]:
    """Aggregates of the rows (``key``, ``v``) with the largest and the smallest value."""
    unknown = F.col("v").isNull()
    top = F.min_by(F.struct(key, "v"), F.struct(unknown, -F.col("v"), F.col(key)))
    return top, F.min_by(F.struct(key, "v"), F.struct(unknown, F.col("v"), F.col(key)))


def named_extremes(key: str) -> list[Column]:
    names = {"fastest": f"t.{key}", "fastest_value": "t.v", "slowest": f"b.{key}", "slowest_value": "b.v"}
    return [F.col(c).alias(n) for n, c in names.items()]


def count_window(
    df: DataFrame, seq: Sequence[str], size: int, aggs: dict[str, Column], keys: Sequence[str] = (), slide: int | None = None
) -> DataFrame:
    """Windows of ``size`` rows per key (all rows when un-keyed), in ``seq`` order.

    Tumbling: incomplete windows never fire; ``block`` counts from 0.  Sliding:
    fires at every ``slide``-th row with the last ``size`` rows (fewer at the
    start); ``block`` is the number of the firing.
    """
    indexed = row_index(df, keys, seq, "_wf_n")
    built = [c.alias(n) for n, c in aggs.items()]
    if slide is None or slide == size:
        blocks = indexed.withColumn("block", F.floor((F.col("_wf_n") - 1) / size))
        out = blocks.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("_wf_rows"), *built)
        return out.where(F.col("_wf_rows") == size).drop("_wf_rows")
    # row n takes part in firings m with m*slide - size < n <= m*slide
    first = F.ceil(F.col("_wf_n") / slide)
    last = F.floor((F.col("_wf_n") + size - 1) / slide)
    spread = indexed.where(first <= last).withColumn("block", F.explode(F.sequence(first, last)))
    out = spread.groupBy(*keys, "block").agg(F.max("_wf_n").alias("_wf_last"), *built)
    return out.where(F.col("_wf_last") == F.col("block") * slide).drop("_wf_last")


def count_window_by_panes(
    df: DataFrame, seq: Sequence[str], size: int, slide: int, partial: dict[str, Column], final: dict[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Sliding count window for large overlaps.

    Rows are aggregated to panes of gcd(size, slide) neighbouring rows first and
    panes, not rows, are copied to the firings they take part in.
    """
    pane = math.gcd(size, slide)
    indexed = row_index(df, keys, seq, "_wf_n").withColumn("_wf_pane", F.floor((F.col("_wf_n") - 1) / pane))
    panes = indexed.groupBy(*keys, "_wf_pane").agg(F.max("_wf_n").alias("_wf_n"), *[c.alias(n) for n, c in partial.items()])
    # pane p holds rows up to (p + 1) * pane and takes part in firing m if m*slide - size < that <= m*slide
    upto = (F.col("_wf_pane") + 1) * pane
    first, last = F.ceil(upto / slide), F.floor((upto + size - 1) / slide)
    spread = panes.where(first <= last).withColumn("block", F.explode(F.sequence(first, last)))
    out = spread.groupBy(*keys, "block").agg(F.max("_wf_n").alias("_wf_last"), *[c.alias(n) for n, c in final.items()])
    return out.where(F.col("_wf_last") == F.col("block") * slide).drop("_wf_last")


def session_ids(df: DataFrame, ts: str, seq: Sequence[str], gap_seconds: float, keys: Sequence[str] = ()) -> DataFrame:
    """Each row with ``session_start``; a new session begins when the distance to the row before exceeds the gap."""
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    f = ordered(df, keys, [ts, *seq]).scan(_wf_prev=previous(ts))
    fresh = F.col("_wf_prev").isNull() | (F.col(ts) - F.col("_wf_prev") > gap)
    f = f.map(lambda d: d.withColumn("_wf_start", F.when(fresh, F.col(ts))))
    return f.scan(session_start=running_max("_wf_start")).frame.drop("_wf_prev", "_wf_start")


def session_window(
    df: DataFrame, ts: str, seq: Sequence[str], gap_seconds: float, aggs: dict[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Session summary; window is ``[first, last + gap)``.

    Built on block scans rather than ``F.session_window`` so that one hot key, or
    no key at all, still spreads over many tasks.
    """
    rows = session_ids(df, ts, seq, gap_seconds, keys)
    out = rows.groupBy(*keys, "session_start").agg(F.max(ts).alias("_wf_last"), *[c.alias(n) for n, c in aggs.items()])
    end = F.col("_wf_last") + F.make_dt_interval(secs=F.lit(gap_seconds))
    return out.select(*keys, F.col("session_start").alias("window_start"), end.alias("window_end"), *aggs)


def session_window_stream(df: DataFrame, ts: str, gap: str, aggs: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """Streaming form per key; :func:`weirflow.streaming.processors.merged_sessions_stream` is the one for hot keys and for none."""
    out = df.groupBy(*keys, F.session_window(ts, gap).alias("_wf_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("_wf_w.start").alias("window_start"), F.col("_wf_w.end").alias("window_end"), *aggs)
