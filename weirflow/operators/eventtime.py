"""Event time, watermarks and late rows as exact batch traces.

The watermark moves after every row in arrival order.  A row is judged by the
watermark *before* it:

    too_late   window_end + lateness <= watermark
    refire     window_end <= watermark < window_end + lateness
    on_time    otherwise

All running maxima are block scans, so no step gathers the table in one task.
Columns added: ``wm`` (before the row, null when nothing was seen) and ``wm_after``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.ordering import ordered, running_count, running_max
from weirflow.session import checkpointed


def _less(ts: Column, seconds: float) -> Column:
    return ts - F.make_dt_interval(secs=F.lit(seconds))


def _at_least(value: Column, start: Column | None) -> Column:
    return value if start is None else F.greatest(value, start)


def bounded_watermark(
    df: DataFrame, ts: str, arrival: Sequence[str], delay_seconds: float = 0, seen: Column | None = None
) -> DataFrame:
    """Largest event time so far minus a fixed delay; ``seen`` is what came before the first row."""
    f = ordered(df, [], arrival).scan(_wf_b=running_max(ts, inclusive=False), _wf_a=running_max(ts))
    return f.frame.withColumns(
        {"wm": _less(_at_least(F.col("_wf_b"), seen), delay_seconds), "wm_after": _less(_at_least(F.col("_wf_a"), seen), delay_seconds)}
    ).drop("_wf_b", "_wf_a")


def punctuated_watermark(
    df: DataFrame, ts: str, arrival: Sequence[str], marker: Column, delay_seconds: float, seen: Column | None = None, wm: Column | None = None
) -> DataFrame:
    """Only marker rows move the watermark: to the largest event time seen so far minus the delay.

    ``seen`` and ``wm`` continue an earlier part of the stream.
    """
    f = ordered(df, [], arrival).scan(_wf_m=running_max(ts))
    moved = _less(_at_least(F.col("_wf_m"), seen), delay_seconds)
    f = f.map(lambda d: d.withColumn("_wf_p", F.when(marker, moved)))
    f = f.scan(_wf_b=running_max("_wf_p", inclusive=False), _wf_a=running_max("_wf_p"))
    return f.frame.withColumns({"wm": _at_least(F.col("_wf_b"), wm), "wm_after": _at_least(F.col("_wf_a"), wm)}).drop(
        "_wf_m", "_wf_p", "_wf_b", "_wf_a"
    )


def per_partition_watermark(
    df: DataFrame, ts: str, arrival: Sequence[str], queue: str, delay_seconds: float, queues: Sequence | None = None
) -> DataFrame:
    """Smallest of the largest event times of the queues seen so far, minus the delay.

    One running maximum per queue; queues are the partitions of a topic, a list
    that does not grow with the data.  Pass it when known, to save the lookup.
    """
    if queues is None:
        queues = [r[0] for r in df.select(queue).distinct().orderBy(queue).collect()]
    of = lambda q: F.when(F.col(queue) == F.lit(q), F.col(ts))
    specs = {f"_wf_b{i}": running_max(of(q), inclusive=False) for i, q in enumerate(queues)}
    specs |= {f"_wf_a{i}": running_max(of(q)) for i, q in enumerate(queues)}
    out = ordered(df, [], arrival).scan(**specs).frame

    def low(side: str) -> Column:
        cols = [F.col(f"_wf_{side}{i}") for i in range(len(queues))]
        return _less(F.least(*cols) if len(cols) > 1 else cols[0], delay_seconds)

    return out.withColumns({"wm": low("b"), "wm_after": low("a")}).drop(*specs)


def time_lag_watermark(df: DataFrame, ingest_ts: str, lag_seconds: float) -> DataFrame:
    """Clock time of arrival minus a fixed lag; needs no other row."""
    wm = _less(F.col(ingest_ts), lag_seconds)
    return df.withColumns({"wm": wm, "wm_after": wm})


def assign_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    w = df.withColumn("_wf_w", F.window(ts, size))
    return w.withColumns({"window_start": F.col("_wf_w.start"), "window_end": F.col("_wf_w.end")}).drop("_wf_w")


def classify(df: DataFrame, lateness_seconds: float = 0) -> DataFrame:
    """Add ``cls`` from ``window_end`` and ``wm``."""
    end, wm = F.col("window_end"), F.col("wm")
    drop_at = end + F.make_dt_interval(secs=F.lit(lateness_seconds))
    return df.withColumn(
        "cls",
        F.when(drop_at <= wm, "too_late").when(end <= wm, "refire").otherwise("on_time"),
    )


def final_watermark(df: DataFrame, ts: str | None = None, delay_seconds: float = 0) -> Column:
    """Watermark after the last row, as a one-row scalar subquery.

    With ``ts`` it is read off the raw rows (largest event time minus the delay),
    which spares computing the trace ``df`` would need.
    """
    if ts is not None:
        return df.select(_less(F.max(ts), delay_seconds)).scalar()
    return df.select(F.max("wm_after")).scalar()


def fired_window_counts(df: DataFrame, keys: Sequence[str], final: Column | None = None) -> DataFrame:
    """On-time count of every window the watermark has passed; open windows are not emitted.

    ``df`` has ``wm``, ``wm_after`` and window columns; ``final`` is the watermark
    after the last row when it is known more cheaply.
    """
    closed = F.col("window_end") <= (final_watermark(df) if final is None else final)
    fired = classify(df).where("cls = 'on_time'").where(closed)
    return fired.groupBy(*keys, "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))


def allowed_lateness_refire(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], lateness_seconds: float, final: Column | None = None
) -> DataFrame:
    """Window results in versions.

    ``version`` 0 is the first firing with all on-time rows; every accepted late
    row emits the window again with the count so far.
    """
    by = [*keys, "window_start", "window_end"]
    closed = F.col("window_end") <= (final_watermark(df) if final is None else final)
    accepted = classify(df, lateness_seconds).where("cls <> 'too_late'").where(closed)
    # the trace is needed for counting the groups and twice below: write it once, few columns wide
    slim = checkpointed(accepted.select(*dict.fromkeys([*by, *arrival, "cls"])))
    first = slim.where("cls = 'on_time'").groupBy(*by).agg(F.count(F.lit(1)).alias("cnt")).withColumn("cls", F.lit("on_time"))
    numbered = ordered(slim, by, arrival).scan(cnt=running_count()).frame
    again = numbered.where("cls = 'refire'").select(*by, "cnt", "cls")
    return first.unionByName(again)


def late_side_output(df: DataFrame, lateness_seconds: float) -> DataFrame:
    """Rows that came after their window was cleared."""
    return classify(df, lateness_seconds).where("cls = 'too_late'")


def late_drop(df: DataFrame) -> DataFrame:
    """Rows left when late ones are dropped without lateness allowance."""
    return classify(df).where("cls = 'on_time'")
