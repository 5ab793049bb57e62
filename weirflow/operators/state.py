"""Keyed state, timers and de-duplication with expiry, in batch form.

Each function has a stateful streaming twin in :mod:`weirflow.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators.ordering import (
    MAX_PARTS,
    as_number,
    latest,
    ordered,
    previous,
    row_index,
    running_count,
    running_max,
    running_sum,
    split_rows_of,
)
from weirflow.session import scratch_path

GROUP_ROWS = 1_000_000
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
# A jump is more than JUMP above the value before; a value over SPEED_LIMIT warns DELAY_SECONDS later.
JUMP, SPEED_LIMIT, DELAY_SECONDS = 30, 100, 2


def speed_jump_alert(df: DataFrame, key: str, value: str, seq: Sequence[str], jump: float = JUMP) -> DataFrame:
    """``<key> over speed: <v>`` when the value rose by more than ``jump`` since the row before, else ``<key>``."""
    f = ordered(df, [key], seq).scan(_wf_prev=previous(value)).frame
    jumped = F.col(value) - F.col("_wf_prev") > jump
    name = F.col(key).cast("string")
    text = F.concat(name, F.lit(" over speed: "), F.col(value).cast("string"))
    return f.withColumn("message", F.when(jumped, text).otherwise(name)).drop("_wf_prev")


def trajectory_steps(df: DataFrame, key: str, seq: Sequence[str], step: Sequence[str]) -> DataFrame:
    """Each row with its position in the trajectory of its key.

    The list a keyed list state would hold after row n is the rows with
    ``pos <= n``; keeping it as rows makes the table linear in the input, where
    repeating the list on every row is quadratic.
    """
    return row_index(df, [key], seq, "pos").select(key, *seq, "pos", *[c for c in step if c not in (key, *seq)])


def trajectory_at(steps: DataFrame, key: str, requests: DataFrame) -> DataFrame:
    """Trajectories as they stood at requested positions; ``requests`` has ``key`` and ``at_pos``."""
    r = requests.select(F.col(key).alias("_wf_k"), "at_pos")
    return steps.join(r, (F.col(key) == F.col("_wf_k")) & (F.col("pos") <= F.col("at_pos"))).drop("_wf_k")


def running_sum_state(df: DataFrame, keys: Sequence[str], value: str, seq: Sequence[str], name: str = "total") -> DataFrame:
    return ordered(df, keys, seq).scan(**{name: running_sum(value)}).frame


def overspeed_timer_alert(df: DataFrame, key: str, value: str, ts: str, limit: float = SPEED_LIMIT, delay_seconds: float = DELAY_SECONDS) -> DataFrame:
    """One warning per (key, fire time); timers for the same key and time are one timer."""
    fire = (F.col(ts) + F.make_dt_interval(secs=F.lit(delay_seconds))).alias("fire_ts")
    return df.where(F.col(value) > limit).select(key, fire).distinct()


def ttl_epochs(df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], ttl_seconds: float):
    """Rows with ``epoch_start``: a distance of ``ttl`` or more to the row before starts a new epoch."""
    ttl = F.make_dt_interval(secs=F.lit(ttl_seconds))
    f = ordered(df, keys, [ts, *seq]).scan(_wf_prev=previous(ts), _wf_n=running_count())
    fresh = F.col("_wf_prev").isNull() | (F.col(ts) - F.col("_wf_prev") >= ttl)
    f = f.map(lambda d: d.withColumns({"_wf_s": F.when(fresh, F.col(ts)), "_wf_at": F.when(fresh, F.col("_wf_n"))}))
    return f.scan(epoch_start=running_max("_wf_s"), _wf_first=running_max("_wf_at"))


def state_ttl_counter(df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], ttl_seconds: float, name: str = "cnt") -> DataFrame:
    """Count per key whose state expires ``ttl`` after its last write."""
    out = ttl_epochs(df, keys, ts, seq, ttl_seconds).frame
    out = out.withColumn(name, F.col("_wf_n") - F.col("_wf_first") + 1)
    return out.drop("_wf_prev", "_wf_n", "_wf_s", "_wf_at", "_wf_first", "epoch_start")


def dedup_with_dup_count(df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], ttl_seconds: float) -> DataFrame:
    """First row of every live epoch and how often the key occurred in it; each duplicate renews the state."""
    rows = ttl_epochs(df, keys, ts, seq, ttl_seconds).frame
    keep = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*keep), F.struct(ts, *seq))
    out = rows.groupBy(*keys, "epoch_start").agg(first.alias("r"), F.count(F.lit(1)).alias("dup_count"))
    return out.select(*keys, *[F.col(f"r.{c}").alias(c) for c in keep], "dup_count")


def dedup_first_seen(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """First row per key, without expiry."""
    keep = [c for c in df.columns if c not in keys]
    if len(seq) == 1 and all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in keep):
        # values of fixed width stay in a hash aggregate; every column takes its value from the same row
        return df.groupBy(*keys).agg(*[F.min_by(c, seq[0]).alias(c) for c in keep]).select(*df.columns)
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*keep), F.struct(*seq)).alias("r"))
    return out.select(*keys, *[F.col(f"r.{c}").alias(c) for c in keep]).select(*df.columns)


def dedup_first_seen_ttl(
    df: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str], ttl_seconds: float, group_rows: int | None = None
) -> DataFrame:
    """First row per key, then the first row at least ``ttl`` after the last *emitted* one, and so on.

    The state is written only on first sight, so each emission depends on the one
    before.  Keys of ordinary size jump through their sorted rows.  Keys above
    ``group_rows`` are solved together by doubling pointers from time to time.
    """
    limit = group_rows or min(GROUP_ROWS, split_rows_of(df, None))
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_wf_n"))
    total, biggest = per_key.agg(F.sum("_wf_n"), F.max("_wf_n")).first()
    timed = df.withColumn("_wf_us", as_number(df, ts))
    if not total or biggest <= limit:
        return _emitted(timed, keys, seq, ttl_seconds).select(*df.columns)
    limit = max(limit, -(-total // MAX_PARTS))
    # fewer than MAX_PARTS keys can hold more than 1/MAX_PARTS of the rows each
    hot = per_key.where(F.col("_wf_n") > limit).select(*[F.col(k).alias(f"_wf_h_{k}") for k in keys])
    cold = timed.join(F.broadcast(hot), _on_hot(keys), "left_anti")
    big = timed.join(F.broadcast(hot), _on_hot(keys), "left_semi")
    return _emitted(cold, keys, seq, ttl_seconds).unionByName(_emitted_by_doubling(big, keys, seq, ttl_seconds)).select(*df.columns)


def _on_hot(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_wf_h_{k}"))
    return on


def _emitted(timed: DataFrame, keys: Sequence[str], seq: Sequence[str], ttl_seconds: float) -> DataFrame:
    """Rows arrive sorted by key and time; each batch jumps from emitted row to emitted row.

    Only the key and time of the last emission are kept, so memory does not grow
    with a key.
    """
    ttl = int(ttl_seconds * 1_000_000)
    sorted_rows = timed.repartition(*keys).sortWithinPartitions(*keys, "_wf_us", *seq)

    def jump(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, last = None, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            at = batch.column("_wf_us").to_numpy()
            key_columns = [batch.column(k) for k in keys]
            starts = _key_starts(key_columns, n)
            picks: list[int] = []
            for a, b in zip(starts, [*starts[1:], n]):
                key = tuple(c[a].as_py() for c in key_columns)
                if key != open_key:
                    last = None
                i = a if last is None else int(np.searchsorted(at[a:b], last + ttl)) + a
                while i < b:
                    picks.append(i)
                    last = int(at[i])
                    i = int(np.searchsorted(at[a:b], last + ttl)) + a
                open_key = key
            yield batch.take(pa.array(picks, pa.int64()))

    return sorted_rows.mapInArrow(jump, timed.schema)


def _key_starts(columns: Sequence[pa.Array], n: int) -> list[int]:
    """Positions where the key differs from the row before."""
    changed = np.zeros(n, dtype=bool)
    changed[0] = True
    for c in columns:
        before, here = c.slice(0, n - 1), c.slice(1)
        differs = pc.fill_null(pc.not_equal(before, here), False)
        one_null = pc.xor(pc.is_null(before), pc.is_null(here))
        changed[1:] |= pc.or_(differs, one_null).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed).tolist()


def _emitted_by_doubling(timed: DataFrame, keys: Sequence[str], seq: Sequence[str], ttl_seconds: float) -> DataFrame:
    """All keys and times at once: every time points to the first one ``ttl`` later, and pointers are doubled from the first time on.

    After i rounds the first 2^i emissions of every key are known and a pointer jumps over 2^i of them, so the number of rounds is the
    logarithm of the longest chain, however many rows or keys there are.
    """
    spark = timed.sparkSession
    ttl = int(ttl_seconds * 1_000_000)
    times = timed.select(*keys, "_wf_us").distinct()
    # every time asks for the smallest one at least ttl later: the latest seen, going back in time
    both = times.select(*keys, (-F.col("_wf_us")).alias("_wf_back"), F.lit(0).alias("_wf_asks"), "_wf_us").unionByName(
        times.select(*keys, (-F.col("_wf_us") - ttl).alias("_wf_back"), F.lit(1).alias("_wf_asks"), "_wf_us"))
    there = F.when(F.col("_wf_asks") == 0, F.col("_wf_us"))
    seen = ordered(both, keys, ["_wf_back", "_wf_asks"]).scan(_wf_next=latest(there)).frame
    jump = _stored(seen.where("_wf_asks = 1 AND _wf_next IS NOT NULL").select(*keys, "_wf_us", "_wf_next"))
    reached = _stored(times.groupBy(*keys).agg(F.min("_wf_us").alias("_wf_us")))
    while True:
        ahead = _stored(_followed(reached, jump, keys))
        if ahead.isEmpty():
            break
        reached = _stored(reached.unionByName(ahead))
        onward = jump.select(*keys, F.col("_wf_us").alias("_wf_from"), F.col("_wf_next").alias("_wf_us"))
        jump = _stored(_followed(onward, jump, keys, "_wf_from").select(*keys, F.col("_wf_from").alias("_wf_us"), F.col("_wf_hit").alias("_wf_next")))
    named = [F.col(k).alias(f"_wf_h_{k}") for k in keys]
    emitted = timed.join(reached.select(*named, F.col("_wf_us").alias("_wf_h")), _on_hot(keys) & (F.col("_wf_us") == F.col("_wf_h")), "left_semi")
    first = F.min_by(F.struct(*timed.columns), F.struct(*seq))
    out = emitted.groupBy(*[F.col(k).alias(f"_wf_g_{k}") for k in keys], F.col("_wf_us").alias("_wf_g")).agg(first.alias("r")).select("r.*")
    return spark.createDataFrame([], timed.schema).unionByName(out)


def _followed(rows: DataFrame, jump: DataFrame, keys: Sequence[str], *kept: str) -> DataFrame:
    """``rows`` moved along the pointer of their time; rows at the end of a chain go."""
    to = jump.select(*[F.col(k).alias(f"_wf_h_{k}") for k in keys], F.col("_wf_us").alias("_wf_h"), F.col("_wf_next").alias("_wf_hit"))
    moved = rows.join(to, _on_hot(keys) & (F.col("_wf_us") == F.col("_wf_h")))
    return moved.select(*keys, *kept, "_wf_hit") if kept else moved.select(*keys, F.col("_wf_hit").alias("_wf_us"))


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "first-seen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trade_totals(df: DataFrame, message_key: str, seq: Sequence[str], user: str, qty: str, cent: str) -> DataFrame:
    """Drop repeated messages, then total quantity and cents per user."""
    first = dedup_first_seen(df.select(message_key, *seq, user, qty, cent), [message_key], seq)
    return first.groupBy(user).agg(F.sum(qty).alias("total_qty"), F.sum(cent).alias("total_cent"))
