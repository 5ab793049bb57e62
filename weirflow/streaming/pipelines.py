"""Running streams: built-in streaming forms, sinks per micro-batch and restart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.operators import eventtime
from weirflow.operators.enrich import LOADED, NOT_FOUND, NOT_FOUND_CITY, lookup_static
from weirflow.operators.ordering import ordered, running_count
from weirflow.operators.windows import extremes, named_extremes, pane_micros, time_window
from weirflow.session import ROCKSDB_PROVIDER, scratch_path
from weirflow.sinks.keyvalue import KeyValueTable


def run_to_table(stream: DataFrame, target: str | None = None, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Drain what is available into a parquet table and return the table."""
    spark = stream.sparkSession
    target = target or scratch_path(spark, "stream-out")
    query = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def run_to_keys(stream: DataFrame, keys: Sequence[str], target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Drain an update-mode aggregate into a key/value table and return the newest row per key."""
    spark = stream.sparkSession
    table = KeyValueTable(spark, target or scratch_path(spark, "stream-keys"), keys)
    table.attach(stream, checkpoint or scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return table.current()


def event_time_counts(stream: DataFrame, ts: str, delay: str, size: str, keys: Sequence[str], slide: str | None = None) -> DataFrame:
    """Windowed counts with Spark's watermark.

    Append mode emits a window once it is closed and drops later rows; update mode
    emits it again on every change.  Unlike the batch traces the watermark moves
    once per micro-batch.
    """
    return time_window(stream.withWatermark(ts, delay), ts, size, {"cnt": F.count(F.lit(1))}, keys, slide)


def sliding_panes_stream(
    stream: DataFrame, ts: str, delay: str, size: str, slide: str, partial: dict[str, Column], final: dict[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Sliding windows through panes, append mode: rows are reduced to panes, only closed panes are copied into their windows."""
    out = _windows_of_panes(stream, ts, delay, size, slide, partial, final, keys)
    return out.select(*keys, F.col("_wf_w.start").alias("window_start"), F.col("_wf_w.end").alias("window_end"), *final)


def _windows_of_panes(
    stream: DataFrame, ts: str, delay: str, size: str, slide: str, partial: dict[str, Column], final: dict[str, Column], keys: Sequence[str]
) -> DataFrame:
    pane = f"{pane_micros(size, slide)} microseconds"
    panes = stream.withWatermark(ts, delay).groupBy(*keys, F.window(ts, pane).alias("_wf_p")).agg(*[c.alias(n) for n, c in partial.items()])
    return panes.groupBy(*keys, F.window("_wf_p", size, slide).alias("_wf_w")).agg(*[c.alias(n) for n, c in final.items()])


def sliding_top_bottom_stream(stream: DataFrame, ts: str, delay: str, key: str, value: str, seq: str, size: str, slide: str) -> DataFrame:
    """Append-mode twin of :func:`weirflow.operators.windows.sliding_top_bottom`.

    State is the last value per key and pane, then per key and window, then the two extremes per window; each level is
    combined before its shuffle and dropped by the watermark.
    """
    panes = {"_l": F.max_by(F.struct(F.col(value).alias("v"), F.col(seq).alias("s")), seq)}
    last = _windows_of_panes(stream, ts, delay, size, slide, panes, {"v": F.max_by("_l.v", "_l.s")}, [key])
    top, low = extremes(key)
    out = last.groupBy("_wf_w").agg(top.alias("t"), low.alias("b"))
    return out.select(F.col("_wf_w.start").alias("window_start"), F.col("_wf_w.end").alias("window_end"), *named_extremes(key))


def allowed_lateness_stream(stream: DataFrame, ts: str, delay_seconds: int, lateness_seconds: int, size: str, keys: Sequence[str]) -> DataFrame:
    """Run in update mode: windows are kept for delay + lateness and emitted again on each accepted late row."""
    return event_time_counts(stream, ts, f"{delay_seconds + lateness_seconds} seconds", size, keys)


class LateRouter:
    """Tags every row ``on_time``, ``refire`` or ``too_late`` with a watermark that moves row by row.

    Spark's own watermark moves per micro-batch and the rows it drops cannot be
    read back.  Here every micro-batch is traced with the batch operators (block
    scans, so it runs on many tasks) starting from two stored values: the largest
    event time seen and the watermark.  Rows and values of a batch go to folders of
    its id, so a replay changes nothing.  With ``marker`` only marked rows move the
    watermark.
    """

    def __init__(
        self, spark: SparkSession, path: str, ts: str, order: Sequence[str], size: str, delay_seconds: float, lateness_seconds: float = 0, marker: Column | None = None
    ):
        self.spark, self.path, self.ts, self.order, self.size = spark, path.rstrip("/"), ts, list(order), size
        self.delay, self.lateness, self.marker = delay_seconds, lateness_seconds, marker

    def _start(self, batch_id: int) -> tuple[Column | None, Column | None]:
        if batch_id == 0:
            return None, None
        stored = self.spark.read.parquet(f"{self.path}/state/batch={batch_id - 1}").first()
        return F.lit(stored["seen"]), F.lit(stored["wm"])

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        seen, wm = self._start(batch_id)
        if self.marker is None:
            traced = eventtime.bounded_watermark(batch, self.ts, self.order, self.delay, seen)
        else:
            traced = eventtime.punctuated_watermark(batch, self.ts, self.order, self.marker, self.delay, seen, wm)
        tagged = eventtime.classify(eventtime.assign_window(traced, self.ts, self.size), self.lateness)
        rows = f"{self.path}/rows/batch={batch_id}"
        tagged.write.mode("overwrite").parquet(rows)
        after = self.spark.read.parquet(rows).agg(F.max(self.ts).alias("seen"), F.max("wm_after").alias("wm"))
        kept = after.select(*[F.greatest(c, v) if v is not None else F.col(c) for c, v in (("seen", seen), ("wm", wm))])
        kept.toDF("seen", "wm").write.mode("overwrite").parquet(f"{self.path}/state/batch={batch_id}")

    def attach(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return for_each_batch(stream, self.handle, checkpoint)

    def rows(self) -> DataFrame:
        base = f"{self.path}/rows"
        return self.spark.read.option("basePath", base).parquet(f"{base}/batch=*").drop("batch")


class RefiringWindows(LateRouter):
    """Window counts in versions on a stream: a window fires when the watermark passes its end, and again for every accepted late row.

    Besides the tagged rows each micro-batch leaves its firings and the counts of the windows that can still change, in folders of
    its id.  Counts of windows past their lateness are not carried on, so what a batch reads is bounded by the open windows.
    """

    def __init__(
        self, spark: SparkSession, path: str, ts: str, keys: Sequence[str], order: Sequence[str], size: str, delay_seconds: float, lateness_seconds: float
    ):
        super().__init__(spark, path, ts, order, size, delay_seconds, lateness_seconds)
        self.keys = list(keys)
        self.by = [*self.keys, "window_start", "window_end"]

    def _counts(self, batch_id: int, like: DataFrame) -> DataFrame:
        if batch_id == 0:
            return like.select(*self.by, F.lit(0).cast("bigint").alias("held"), F.lit(False).alias("fired")).limit(0)
        return self.spark.read.parquet(f"{self.path}/counts/batch={batch_id - 1}")

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        super().handle(batch, batch_id)
        rows = self.spark.read.parquet(f"{self.path}/rows/batch={batch_id}").where("cls <> 'too_late'")
        held = self._counts(batch_id, rows)
        wm = F.lit(self.spark.read.parquet(f"{self.path}/state/batch={batch_id}").first()["wm"]).cast("timestamp")
        came = rows.groupBy(*self.by).agg(F.count_if(F.col("cls") == "on_time").alias("on_time"), F.count(F.lit(1)).alias("came"))
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in self.by]
        both = held.alias("a").join(came.alias("b"), same, "full").select(
            *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in self.by], F.coalesce("held", F.lit(0)).alias("before"),
            F.coalesce("fired", F.lit(False)).alias("had"), F.coalesce("on_time", F.lit(0)).alias("on_time"), F.coalesce("came", F.lit(0)).alias("came"))
        before = F.col("before") + F.col("on_time")
        # a window that is closed never fires first again, also where all its rows came late
        closed = F.coalesce(F.col("window_end") <= wm, F.lit(False))
        windows = f"{self.path}/windows/batch={batch_id}"
        both.withColumns({"fires": ~F.col("had") & closed & (before > 0), "closed": closed}).write.mode("overwrite").parquet(windows)
        both = self.spark.read.parquet(windows)
        first = both.where("fires").select(*self.by, before.alias("cnt"), F.lit("on_time").alias("cls"))
        numbered = ordered(rows.select(*dict.fromkeys([*self.by, *self.order, "cls"])), self.by, self.order).scan(_wf_n=running_count()).frame
        late = numbered.where("cls = 'refire'").alias("b").join(both.alias("a"), same)
        again = late.select(*[F.col(f"b.{c}").alias(c) for c in self.by], (F.col("before") + F.col("_wf_n")).alias("cnt"), F.col("b.cls").alias("cls"))
        first.unionByName(again).write.mode("overwrite").parquet(f"{self.path}/firings/batch={batch_id}")
        over = F.coalesce(F.col("window_end") + F.make_dt_interval(secs=F.lit(self.lateness)) <= wm, F.lit(False))
        left = both.where(~over).select(*self.by, (F.col("before") + F.col("came")).alias("held"), F.col("closed").alias("fired"))
        left.write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch_id}")

    def firings(self) -> DataFrame:
        base = f"{self.path}/firings"
        return self.spark.read.option("basePath", base).parquet(f"{base}/batch=*").drop("batch")


def per_source_watermark(streams: Sequence[DataFrame], ts: str, delay: str) -> DataFrame:
    """One watermark per input, the smallest counts (``spark.sql.streaming.multipleWatermarkPolicy=min``)."""
    marked = [s.withWatermark(ts, delay) for s in streams]
    out = marked[0]
    for s in marked[1:]:
        out = out.unionByName(s)
    return out


def count_changes(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count so far, one row per changed key and micro-batch (update mode)."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def dedup_within_watermark(stream: DataFrame, ts: str, keys: Sequence[str], ttl: str) -> DataFrame:
    """Built-in de-duplication; state is dropped ``ttl`` after the first row, on the watermark."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(list(keys))


def for_each_batch(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def lookup_refreshing(
    stream: DataFrame, load_dimension: Callable[[], DataFrame], on: str, dim_key: str, value: str, target: str, checkpoint: str, every: str = "5 seconds", default: str = NOT_FOUND, available_now: bool = True
) -> StreamingQuery:
    """Join every micro-batch with the dimension as it is then; ``every`` is the refresh pace."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        lookup_static(batch, load_dimension(), on, dim_key, value, default).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


class ConfigLookup:
    """Lookups and configuration arrive in one stream, told apart by ``is_config``.

    A micro-batch first stores its configuration rows, then answers its lookups
    from the stored state; every configuration row is acknowledged.  Change order finer than a micro-batch is what the batch
    form :func:`weirflow.operators.enrich.lookup_config_stream` gives.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, value: str, seq: str, default: str = NOT_FOUND_CITY):
        self.config = KeyValueTable(spark, f"{path}/config", [key])
        self.key, self.value, self.seq, self.default = key, value, seq, default
        self.out, self.acks = f"{path}/answers", f"{path}/acks"

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.where("is_config").select(self.key, self.value, self.seq)
        self.config.put(rows, batch_id, self.seq, across=True)
        text = F.concat(F.col(self.key).cast("string"), F.lit(" "), F.col(self.value), F.lit(LOADED))
        rows.select(self.seq, text.alias("answer")).write.mode("overwrite").parquet(f"{self.acks}/batch={batch_id}")
        dim = self.config.current().select(F.col(self.key).alias("_wf_id"), self.value)
        asked = batch.where("NOT is_config").drop("is_config", self.value)
        lookup_static(asked, dim, self.key, "_wf_id", self.value, self.default).write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")

    def acknowledgements(self) -> DataFrame:
        """One text per configuration row that was stored."""
        return self.config.spark.read.option("basePath", self.acks).parquet(f"{self.acks}/batch=*").drop("batch")

    def answers(self) -> DataFrame:
        return self.config.spark.read.option("basePath", self.out).parquet(f"{self.out}/batch=*").drop("batch")


class RunningTotals:
    """Totals per key updated per micro-batch, safe to replay.

    Each batch leaves its own partial sums under its id; a replayed batch
    overwrites them, so nothing is added twice.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sums: dict[str, Column]):
        self.spark, self.path, self.keys, self.sums = spark, path.rstrip("/"), list(keys), sums

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(*self.keys).agg(*[F.sum(c).alias(n) for n, c in self.sums.items()])
        part.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def totals(self) -> DataFrame:
        rows = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        return rows.groupBy(*self.keys).agg(*[F.sum(n).alias(n) for n in self.sums])


def checkpointed_query(stream: DataFrame, target: str, checkpoint: str, mode: str = "append", trigger: str | None = None) -> StreamingQuery:
    """Exactly-once file output with state in RocksDB.

    The checkpoint folder stays when the query is stopped; starting again with the
    same folder goes on where it ended.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    writer = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
