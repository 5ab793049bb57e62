"""Stateful processors: the streaming twins of the ordered batch operators.

All of them share one processor that keeps a small tuple of state per key and
calls a step function per row in ``seq`` order of the micro-batch.  Use built-in
streaming aggregates where one row per key and trigger is enough; these are for
results on every row.  Rows of one key are handled by one task per micro-batch:
bound the micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) where a
key may be hot.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirflow.operators.enrich import NOT_FOUND_CITY
from weirflow.operators.state import DELAY_SECONDS, JUMP, SPEED_LIMIT
from weirflow.session import ROCKSDB_PROVIDER

# (state or None, row) -> (new state or None to leave it, output tuples)
Step = Callable[[tuple | None, tuple], tuple[tuple | None, list[tuple]]]


class KeyedStep(StatefulProcessor):
    """Runs ``step`` over the rows of a key in order, with one value state."""

    def __init__(self, step: Step, state_schema: T.StructType, columns: Sequence[str], out: Sequence[str], seq: Sequence[str], ttl_ms: int | None = None):
        self.step, self.state_schema, self.columns = step, state_schema, list(columns)
        self.out, self.seq, self.ttl_ms = list(out), list(seq), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("s", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # bounded by one micro-batch (maxFilesPerTrigger / maxOffsetsPerTrigger)
        frames = [b for b in rows if not b.empty]
        if not frames:
            yield pd.DataFrame()
            return
        batch = pd.concat(frames, ignore_index=True).sort_values(self.seq, kind="stable")
        state = tuple(self.state.get()) if self.state.exists() else None
        changed, results = False, []
        for row in batch[self.columns].itertuples(index=False, name=None):
            new, emitted = self.step(state, row)
            if new is not None:
                state, changed = new, True
            results.extend((*key, *e) for e in emitted)
        if changed:
            self.state.update(state)
        yield pd.DataFrame(results, columns=self.out)

    def close(self) -> None:
        pass


def keyed_step(
    stream: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: Sequence[str], step: Step, state_schema: str, out_schema: str, ttl_ms: int | None = None
) -> DataFrame:
    """Apply a step function per key.  Output columns are the keys followed by ``out_schema``."""
    use_rocksdb(stream)
    # plain names inside: Spark renames columns that start with an underscore on the way to Python
    inner = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*keys, *columns, *seq]))}
    slim = stream.select(*[F.col(c).alias(n) for c, n in inner.items()])
    key_schema = ", ".join(f"`{k}` {stream.schema[k].dataType.simpleString()}" for k in keys)
    schema = T.StructType.fromDDL(f"{key_schema}, {out_schema}")
    processor = KeyedStep(
        step, T.StructType.fromDDL(state_schema), [inner[c] for c in columns], schema.names, [inner[c] for c in seq], ttl_ms
    )
    mode = "ProcessingTime" if ttl_ms else "None"
    return slim.groupBy(*[inner[k] for k in keys]).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=mode
    )


def use_rocksdb(stream: DataFrame) -> None:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def running_count_stream(stream: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One output per input row with the count so far."""

    def step(state, row):
        n = (state[0] if state else 0) + 1
        return (n,), [(row[0], n)]

    kind = stream.schema[seq].dataType.simpleString()
    return keyed_step(stream, keys, [seq], [seq], step, "n bigint", f"`{seq}` {kind}, cnt bigint")


def running_sum_stream(stream: DataFrame, keys: Sequence[str], value: str, seq: str) -> DataFrame:
    def step(state, row):
        total = (state[0] if state else 0) + row[1]
        return (total,), [(row[0], total)]

    return keyed_step(stream.withColumn(value, F.col(value).cast("long")), keys, [seq, value], [seq], step, "s bigint", f"`{seq}` bigint, total bigint")


def changelog_stream(stream: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Running count as ``(false, old)`` / ``(true, new)`` pairs."""

    def step(state, row):
        old = state[0] if state else 0
        new = (row[0], True, old + 1)
        return (old + 1,), ([(row[0], False, old), new] if old else [new])

    return keyed_step(stream, keys, [seq], [seq], step, "n bigint", f"`{seq}` bigint, op boolean, value bigint")


def speed_jump_stream(stream: DataFrame, key: str, value: str, seq: str, jump: float = JUMP) -> DataFrame:
    """Compare every value with the one before; ``jumped`` tells which message applies."""

    def step(state, row):
        jumped = bool(state) and row[1] - state[0] > jump
        return (row[1],), [(row[0], row[1], jumped)]

    out = keyed_step(stream.withColumn(value, F.col(value).cast("double")), [key], [seq, value], [seq], step, "v double", f"`{seq}` bigint, `{value}` double, jumped boolean")
    name = F.col(key).cast("string")
    text = F.when(F.col("jumped"), F.concat(name, F.lit(" over speed: "), F.col(value).cast("string"))).otherwise(name)
    return out.select(key, seq, text.alias("message"))


def trajectory_stream(stream: DataFrame, key: str, seq: str, step_col: str) -> DataFrame:
    """Position of every row in the trajectory of its key; state is one number, not the whole list."""

    def step(state, row):
        n = (state[0] if state else 0) + 1
        return (n,), [(row[0], n, str(row[1]))]

    return keyed_step(stream, [key], [seq, step_col], [seq], step, "n bigint", f"`{seq}` bigint, pos bigint, `{step_col}` string")


def ttl_counter_stream(stream: DataFrame, keys: Sequence[str], us: str, seq: str, ttl_us: int, idle_ms: int | None = None) -> DataFrame:
    """Counter that starts again when the last row is ``ttl_us`` or more ago (event time in microseconds).

    ``idle_ms`` drops the state of a key that was not written for so long on the clock; it should be well above the ttl
    and the delay of the input, so that only keys go whose epoch is over anyway.
    """

    def step(state, row):
        seq_v, at = row
        n = state[1] + 1 if state and at - state[0] < ttl_us else 1
        return (at, n), [(seq_v, n)]

    return keyed_step(stream, keys, [seq, us], [us, seq], step, "at bigint, n bigint", f"`{seq}` bigint, cnt bigint", idle_ms)


def ttl_counter_clock_stream(stream: DataFrame, keys: Sequence[str], seq: str, ttl_ms: int) -> DataFrame:
    """The same with Spark's state TTL on the processing clock, renewed on every write."""

    def step(state, row):
        n = (state[0] if state else 0) + 1
        return (n,), [(row[0], n)]

    return keyed_step(stream, keys, [seq], [seq], step, "n bigint", f"`{seq}` bigint, cnt bigint", ttl_ms)


def first_seen_stream(stream: DataFrame, keys: Sequence[str], us: str, seq: str, ttl_us: int, idle_ms: int | None = None) -> DataFrame:
    """Emit a row when its key was never emitted or was last emitted ``ttl_us`` or more ago; ``idle_ms`` as in the counter."""

    def step(state, row):
        seq_v, at = row
        if state and at - state[0] < ttl_us:
            return None, []
        return (at,), [(seq_v, at)]

    return keyed_step(stream, keys, [seq, us], [us, seq], step, "at bigint", f"`{seq}` bigint, `{us}` bigint", idle_ms)


def dup_count_stream(stream: DataFrame, keys: Sequence[str], us: str, seq: str, ttl_us: int, idle_ms: int | None = None) -> DataFrame:
    """Every row with its number in the live epoch; number 1 is the row that passes, the rest are duplicates; ``idle_ms`` as above."""

    def step(state, row):
        seq_v, at = row
        n = state[1] + 1 if state and at - state[0] < ttl_us else 1
        return (at, n), [(seq_v, n, n == 1)]

    return keyed_step(stream, keys, [seq, us], [us, seq], step, "at bigint, n bigint", f"`{seq}` bigint, cnt bigint, first boolean", idle_ms)


def count_window_stream(stream: DataFrame, keys: Sequence[str], value: str, seq: str, size: int) -> DataFrame:
    """Blocks of ``size`` rows per key: count, total of ``value`` and first ``seq``; state is one row, blocks that are not full stay open."""

    def step(state, row):
        block, n, total, first = state or (0, 0, 0, row[0])
        n, total = n + 1, total + row[1]
        if n < size:
            return (block, n, total, first if n > 1 else row[0]), []
        return (block + 1, 0, 0, 0), [(block, n, total, first if n > 1 else row[0])]

    slim = stream.withColumn(value, F.col(value).cast("long"))
    return keyed_step(slim, keys, [seq, value], [seq], step, "block bigint, n bigint, total bigint, first bigint", "block bigint, cnt bigint, total bigint, first_id bigint")


def count_window_sliding_stream(stream: DataFrame, keys: Sequence[str], value: str, seq: str, size: int, slide: int) -> DataFrame:
    """Every ``slide`` rows of a key, the last ``size`` of them; state holds at most ``size`` rows."""

    def step(state, row):
        n, rows = (state[0], [tuple(r) for r in state[1]]) if state else (0, [])
        rows = [*rows, (row[0], row[1])][-size:]
        n += 1
        out = [(n // slide, len(rows), sum(v for _, v in rows), rows[0][0])] if n % slide == 0 else []
        return (n, rows), out

    slim = stream.withColumn(value, F.col(value).cast("long"))
    return keyed_step(slim, keys, [seq, value], [seq], step, "n bigint, rows array<struct<s: bigint, v: bigint>>", "block bigint, cnt bigint, total bigint, first_id bigint")


class _TimerAlert(StatefulProcessor):
    def __init__(self, value: str, ts_ms: str, limit: float, delay_ms: int, clock: bool):
        self.value, self.ts_ms, self.limit, self.delay_ms, self.clock = value, ts_ms, limit, delay_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs() if self.clock else None
        for batch in rows:
            if batch.empty:  # a timer is due but the key has no new rows
                continue
            fast = batch[batch[self.value] > self.limit]
            for at in fast[self.ts_ms].tolist():
                self.handle.registerTimer((now if self.clock else at) + self.delay_ms)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield pd.DataFrame([(*key, expiredTimerInfo.getExpiryTimeInMs())], columns=["key", "fire_ms"])

    def close(self) -> None:
        pass


def overspeed_timer_stream(stream: DataFrame, key: str, value: str, ts: str, limit: float = SPEED_LIMIT, delay_ms: int = 1000 * DELAY_SECONDS, clock: bool = False) -> DataFrame:
    """Register a timer for fast rows and emit ``(key, fire_ms)`` when it expires.

    ``clock`` uses processing time; otherwise event time, which needs a watermark on ``ts``.
    """
    use_rocksdb(stream)
    kind = stream.schema[key].dataType.simpleString()
    slim = stream.select(F.col(key).alias("k"), F.col(value).alias("v"), F.col(ts).alias("at"), F.unix_millis(ts).alias("ms"))
    return slim.groupBy("k").transformWithStateInPandas(
        statefulProcessor=_TimerAlert("v", "ms", limit, delay_ms, clock),
        outputStructType=T.StructType.fromDDL(f"key {kind}, fire_ms bigint"),
        outputMode="Append",
        timeMode="ProcessingTime" if clock else "EventTime",
    )


# keys that share a call and a state: a call per key costs a processor far more than the few rows of the key. Part of the state's layout
BUCKETS = 1024
# spelled out, because workers have no session to parse type strings with
HELD = T.StructType([T.StructField("held", T.StringType())])
_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
MERGES: dict[str, Callable] = {"sum": lambda a, b: a + b, "min": min, "max": max}


def _keys_as_text(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*keys), _MICROS)


def _bucket(text: str) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int")


def _held(state) -> dict:
    return json.loads(state.get()[0]) if state.exists() else {}


class _MergeCells(StatefulProcessor):
    """Joins closed cells of the keys of a bucket to sessions.  Cells come in event-time order over the batches; state is the open session of each key."""

    def __init__(self, gap_us: int, merges: dict[str, str], out: Sequence[str]):
        self.gap_us, self.merges, self.out = gap_us, merges, list(out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", HELD)

    def _merged(self, a: dict, b: dict) -> dict:
        return {n: MERGES[how](a[n], b[n]) if n in a and n in b else a.get(n, b.get(n)) for n, how in self.merges.items() if n in a or n in b}

    def _due(self, last: int) -> int:
        # end of the cell in which a row could still join: by then the watermark has let that cell through
        return ((last + self.gap_us) // self.gap_us + 1) * self.gap_us // 1000 + 1

    def _keep(self, held: dict) -> int:
        """Stores the open sessions; gives the time when the first of them is over."""
        due = min(self._due(now[1]) for now in held.values())
        self.open.update((json.dumps({"due": due, "open": held}),))
        return due

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one row per cell, so at most one per key and gap of event time
        frames = [b for b in rows if not b.empty]
        if not frames:
            yield pd.DataFrame()
            return
        cells = pd.concat(frames, ignore_index=True).sort_values("first")
        stored = _held(self.open)
        held, done = stored.get("open", {}), []
        for k, first, last, aggs in zip(*(cells[c].tolist() for c in ("key", "first", "last", "aggs")), strict=True):
            aggs, now = json.loads(aggs), held.get(k)
            if now and first - now[1] <= self.gap_us:
                held[k] = [now[0], max(now[1], last), self._merged(now[2], aggs)]
                continue
            if now:
                done.append((k, now[0], now[1], json.dumps(now[2])))
            held[k] = [first, last, aggs]
        due = self._keep(held)
        if stored and stored["due"] != due:
            self.handle.deleteTimer(stored["due"])
        if not stored or stored["due"] != due:
            self.handle.registerTimer(due)
        yield pd.DataFrame(done, columns=self.out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored, at = _held(self.open), expiredTimerInfo.getExpiryTimeInMs()
        if not stored or stored["due"] > at:
            yield pd.DataFrame()
            return
        # the sessions that are over, not only the first of them: a timer is expired once the watermark is above it
        over = max(at + 1, timerValues.getCurrentWatermarkInMs())
        done = [(k, now[0], now[1], json.dumps(now[2])) for k, now in stored["open"].items() if self._due(now[1]) < over]
        held = {k: now for k, now in stored["open"].items() if self._due(now[1]) >= over}
        if held:
            self.handle.registerTimer(self._keep(held))
        else:
            self.open.clear()
        yield pd.DataFrame(done, columns=self.out)

    def close(self) -> None:
        pass


def merged_sessions_stream(
    stream: DataFrame, ts: str, delay: str, gap_seconds: int, aggs: dict[str, tuple[Column, str]], keys: Sequence[str] = ()
) -> DataFrame:
    """Session windows in append mode in two levels, without a key as well.

    Rows are aggregated to cells of one gap first, by as many tasks as there are cells: rows of one cell always share a session.  Only
    closed cells go on to the sessions, one row per key and gap of event time however many rows there are.  ``aggs`` gives
    each aggregate with the way its parts are merged (``sum``, ``min`` or ``max``; values that JSON keeps in order).  Rows without a
    time belong to no session.
    """
    use_rocksdb(stream)
    gap_us = gap_seconds * 1_000_000
    by = list(keys) or ["all"]
    marked = stream.withWatermark(ts, delay)
    marked = marked if keys else marked.withColumn("all", F.lit(1))
    cells = marked.groupBy(*by, F.window(ts, f"{gap_us} microseconds").alias("cell")).agg(
        F.unix_micros(F.min(ts)).alias("first"), F.unix_micros(F.max(ts)).alias("last"), *[c.alias(f"agg_{n}") for n, (c, _) in aggs.items()])
    parts = T.StructType([T.StructField(n, cells.schema[f"agg_{n}"].dataType) for n in aggs])
    inner = [f"k{i}" for i in range(len(by))]
    named = T.StructType([T.StructField(i, cells.schema[k].dataType) for k, i in zip(by, inner)])
    slim = cells.select(
        _keys_as_text([F.col(k).alias(i) for k, i in zip(by, inner)]).alias("key"), F.window_time("cell").alias("at"), "first", "last",
        F.to_json(F.struct(*[F.col(f"agg_{n}").alias(n) for n in aggs])).alias("aggs")).withColumn("bucket", _bucket("key"))
    schema = T.StructType().add("key", T.StringType()).add("first", T.LongType()).add("last", T.LongType()).add("aggs", T.StringType())
    out = slim.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_MergeCells(gap_us, {n: how for n, (_, how) in aggs.items()}, schema.names),
        outputStructType=schema, outputMode="Append", timeMode="EventTime")
    merged = out.withColumns({"aggs": F.from_json("aggs", parts), "key": F.from_json("key", named, _MICROS)})
    return merged.select(
        *[F.col(f"key.{i}").alias(k) for k, i in zip(keys, inner)], F.timestamp_micros("first").alias("window_start"),
        F.timestamp_micros(F.col("last") + gap_us).alias("window_end"), *[F.col(f"aggs.{n}").alias(n) for n in aggs])


class _VersionedLookup(StatefulProcessor):
    """Answers lookups of the keys of a bucket from their versions of the configuration, by binary search in event order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getValueState("versions", HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [b for b in rows if not b.empty]
        if not frames:
            yield pd.DataFrame()
            return
        batch = pd.concat(frames, ignore_index=True)
        # of each key: places (us, seq) in order, and their values
        held = {k: ([*map(tuple, order)], values) for k, (order, values) in _held(self.versions).items()}
        config, fresh = batch[batch["cfg"] & batch["value"].notna()].sort_values("value"), {}
        for k, us, seq, value in zip(*(config[c].tolist() for c in ("key", "us", "seq", "value")), strict=True):
            fresh.setdefault(k, {})[(int(us), int(seq))] = value
        for k, changes in fresh.items():
            merged = dict(zip(*held.get(k, ([], [])), strict=True)) | changes
            order = sorted(merged)
            held[k] = order, [merged[at] for at in order]
        asked, answers = batch[~batch["cfg"]], []
        for k, us, seq in zip(*(asked[c].tolist() for c in ("key", "us", "seq")), strict=True):
            order, values = held.get(k, ([], []))
            at = bisect_right(order, (us, seq))
            answers.append((k, seq, values[at - 1] if at else None))
        if fresh:
            # rows at or before the watermark are not let in any more: of the versions up to it the newest is enough
            passed = (timerValues.getCurrentWatermarkInMs() * 1000, float("inf"))
            for k in fresh:
                order, values = held[k]
                first = max(bisect_right(order, passed) - 1, 0)
                held[k] = order[first:], values[first:]
            self.versions.update((json.dumps(held),))
        yield pd.DataFrame(answers, columns=["key", "seq", "label"])

    def close(self) -> None:
        pass


def config_lookup_stream(
    stream: DataFrame, key: str, ts: str, seq: str, is_config: str, value: str, delay: str, default: str = NOT_FOUND_CITY, name: str = "label"
) -> DataFrame:
    """As-of lookup inside a stream that carries lookups and configuration.

    A lookup gets the newest value of its key at or before it in the order (``ts``, ``seq``), among the configuration rows that arrived up to
    its micro-batch; both may be late by ``delay``.  Of two values at one place the greater counts; a null value changes nothing,
    an empty one gives the default.  Spark's watermark starts at the epoch, so rows up to 1970 are late.  State per key: the versions above the watermark and one below.
    """
    use_rocksdb(stream)
    slim = stream.withWatermark(ts, delay).select(
        _keys_as_text([F.col(key).alias("k")]).alias("key"), F.col(ts).alias("at"), F.unix_micros(ts).alias("us"), F.col(seq).cast("bigint").alias("seq"),
        F.coalesce(F.col(is_config), F.lit(False)).alias("cfg"), F.col(value).cast("string").alias("value")).withColumn("bucket", _bucket("key"))
    named = T.StructType([T.StructField("k", stream.schema[key].dataType)])
    out = slim.where("at IS NOT NULL").groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_VersionedLookup(), outputStructType=T.StructType.fromDDL("key string, seq bigint, label string"),
        outputMode="Append", timeMode="EventTime")
    return out.select(
        F.from_json("key", named, _MICROS)["k"].alias(key), F.col("seq").alias(seq), F.coalesce(F.nullif("label", F.lit("")), F.lit(default)).alias(name))
