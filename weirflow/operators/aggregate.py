"""Keyed aggregations, running values and change logs."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from weirflow.functions import states
from weirflow.operators.ordering import latest, ordered, running_count, running_sum
from weirflow.operators.reshape import flat_map_split


def word_count(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """(word, cnt) over all tokens; counts combine in the map tasks before the shuffle."""
    return flat_map_split(df, text, sep).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_count_by_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str], name: str = "cnt") -> DataFrame:
    """Each input row with the number of rows of its key so far."""
    return ordered(df, keys, seq).scan(**{name: running_count()}).frame


def keyed_reduce(df: DataFrame, keys: Sequence[str], folds: dict[str, Column]) -> DataFrame:
    """Associative folds that Spark has as aggregates."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in folds.items()])


def keyed_fold(
    df: DataFrame, keys: Sequence[str], value: str, combine: Callable[[object, object], object], value_type: T.DataType | str, name: str = "folded"
) -> DataFrame:
    """Any associative, commutative ``combine(old, current)`` over the values of a key.

    Folded once per task before the shuffle and once more per key after it, so a
    hot key moves one row per map task, never all of its rows.
    """
    keys = list(keys)
    kind = value_type.simpleString() if isinstance(value_type, T.DataType) else value_type
    key_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_schema}, `{name}` {kind}"

    def fold_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[tuple, object] = {}
        for batch in batches:
            for *k, v in batch.itertuples(index=False, name=None):
                k = tuple(k)
                acc[k] = combine(acc[k], v) if k in acc else v
            if len(acc) > 500_000:  # hand over early; the next fold completes it
                yield pd.DataFrame([(*k, v) for k, v in acc.items()], columns=[*keys, name])
                acc = {}
        if acc:
            yield pd.DataFrame([(*k, v) for k, v in acc.items()], columns=[*keys, name])

    partial = df.select(*keys, F.col(value).cast(kind).alias(name)).mapInPandas(fold_batches, schema)

    def fold_group(group: pd.DataFrame) -> pd.DataFrame:
        values = iter(group[name].tolist())
        out = next(values)
        for v in values:
            out = combine(out, v)
        return group.iloc[:1].assign(**{name: [out]})

    return partial.groupBy(*keys).applyInPandas(fold_group, schema)


def keyed_basic_aggs(df: DataFrame, keys: Sequence[str], value: str, row: Sequence[str], seq: str) -> DataFrame:
    """sum, min, max of ``value`` and the ``row`` columns where it is smallest / largest (first such row)."""
    unknown = F.col(value).isNull()
    first_low = F.struct(unknown, F.col(value), F.col(seq))
    first_high = F.struct(unknown, -F.col(value), F.col(seq))
    whole = F.struct(*row)
    out = df.groupBy(*keys).agg(
        F.sum(value).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.min_by(whole, first_low).alias("lo"),
        F.min_by(whole, first_high).alias("hi"),
    )
    return out.select(
        *keys, "sum", "min", "max",
        *[F.col(f"lo.{c}").alias(f"min_by_{c}") for c in row],
        *[F.col(f"hi.{c}").alias(f"max_by_{c}") for c in row],
    )


def flow_per_monitor(df: DataFrame, monitor: str) -> DataFrame:
    return df.groupBy(monitor).agg(F.count(F.lit(1)).alias("flow"))


def flow_per_monitor_minute(df: DataFrame, monitor: str, ts: str) -> DataFrame:
    minute = F.date_format(ts, "yyyyMMddHHmm").alias("minute")
    return df.groupBy(monitor, minute).agg(F.count(F.lit(1)).alias("flow"))


def table_group_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def retract_changelog(df: DataFrame, keys: Sequence[str], seq: Sequence[str], value: Column | None = None, name: str = "value") -> DataFrame:
    """Per input row: ``(false, old total)`` unless it is the first of its key, then ``(true, new total)``.

    ``value`` is summed, a null adds nothing; rows are counted when it is left out.
    """
    add = F.lit(1).cast("long") if value is None else value
    run = ordered(df.withColumn("_wf_add", add), keys, seq).scan(
        _wf_n=running_count(), _wf_new=running_sum("_wf_add"), _wf_old=running_sum("_wf_add", inclusive=False)
    ).frame
    new = F.struct(F.lit(True).alias("op"), F.col("_wf_new").alias(name))
    old = F.struct(F.lit(False).alias("op"), F.col("_wf_old").alias(name))
    pair = F.when(F.col("_wf_n") == 1, F.array(new)).otherwise(F.array(old, new))
    keep = list(dict.fromkeys([*keys, *seq]))
    return run.select(*keep, F.explode(pair).alias("c")).select(*keep, "c.op", f"c.{name}")


def keep_current(changelog: DataFrame) -> DataFrame:
    """Only the new values of a change log."""
    return changelog.where("op")


def udaf_average(df: DataFrame, keys: Sequence[str], value: str, name: str = "avg") -> DataFrame:
    """Average as an explicit (sum, count) accumulator with a final division."""
    acc = df.groupBy(*keys).agg(F.sum(value).alias("acc_sum"), F.count(value).alias("acc_cnt"))
    return acc.select(*keys, "acc_sum", "acc_cnt", (F.col("acc_sum").cast("double") / F.col("acc_cnt")).alias(name))


@dataclass(frozen=True)
class Accumulator:
    """A user's aggregate: ``create()``, ``add(acc, row)`` for a tuple of the input columns, ``merge(a, b)`` and ``result(acc)``, a tuple."""

    create: Callable[[], object]
    add: Callable[[object, tuple], object]
    merge: Callable[[object, object], object]
    result: Callable[[object], tuple]


def udaf(df: DataFrame, keys: Sequence[str], columns: Sequence[str], acc: Accumulator, schema: str) -> DataFrame:
    """Aggregate ``columns`` per key with a user's accumulator; output is the keys and ``schema``.

    Each task adds its rows up and sends one accumulator per key and batch, so a hot key sends no rows.  Use built-in aggregates where
    they fit.
    """
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    inner = df.select(*named, *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    ks, vs = [f"k{i}" for i in range(len(keys))], [f"v{i}" for i in range(len(columns))]
    key_schema = ", ".join(f"{k} {df.schema[c].dataType.simpleString()}" for k, c in zip(ks, keys))

    names = T.StructType.fromDDL(schema).names

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, group in batch.groupby(ks, sort=False, dropna=False):
                state = acc.create()
                for row in group[vs].itertuples(index=False, name=None):
                    state = acc.add(state, row)
                out.append((*key, pickle.dumps(state)))
            yield pd.DataFrame(out, columns=[*ks, "acc"])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        state = acc.create()
        for blob in group["acc"]:
            state = acc.merge(state, pickle.loads(blob))
        return pd.DataFrame([(*group[ks].iloc[0], *acc.result(state))], columns=[*ks, *names])

    parts = inner.mapInPandas(partial, f"{key_schema}, acc binary")
    out = parts.groupBy(*ks).applyInPandas(finish, f"{key_schema}, {schema}")
    return out.withColumnsRenamed(dict(zip(ks, keys)))


def ordered_fold(df: DataFrame, keys: Sequence[str], seq: Sequence[str], value: str, fold: Callable[[object, object], object], initial, kind: str, name: str = "folded") -> DataFrame:
    """Fold the values of a key in arrival order: ``fold(old, current)`` from ``initial``; one row per key.

    The function need not be associative, so the rows of a key go through one task, in batches; only the folded value is held.
    """
    ks = [f"k{i}" for i in range(len(keys))]
    inner = df.select(*[F.col(k).alias(n) for n, k in zip(ks, keys)], F.col(value).alias("v"), *[F.col(c).alias(f"s{i}") for i, c in enumerate(seq)])
    rows = inner.repartition(*ks).sortWithinPartitions(*ks, *[f"s{i}" for i in range(len(seq))]).select(*ks, "v")
    key_schema = ", ".join(f"{k} {df.schema[c].dataType.simpleString()}" for k, c in zip(ks, keys))

    folded = to_arrow_type(T.StructType.fromDDL(f"x {kind}")[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, kinds = None, initial, []

        def done(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[*ks, "folded"])

        for batch in batches:
            kinds = [*(f.type for f in list(batch.schema)[:-1]), folded]
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:-1] != key:
                    if key is not None:
                        out.append((*key, state))
                    key, state = row[:-1], initial
                state = fold(state, row[-1])
            if out:
                yield done(out)
        if key is not None:
            yield done([(*key, state)])

    return rows.mapInArrow(run, f"{key_schema}, folded {kind}").withColumnsRenamed({**dict(zip(ks, keys)), "folded": name})


def agg_state_partial(df: DataFrame, keys: Sequence[str], aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Stored partial states: output name -> (state kind, column).  Kinds are in :mod:`functions.states`."""
    built = [c for n, (kind, col) in aggs.items() for c in states.build(kind, col, n)]
    return df.groupBy(*keys).agg(*built)


def agg_state_merge(partial: DataFrame, keys: Sequence[str], aggs: dict[str, tuple[str, str]], finish: bool = True) -> DataFrame:
    """Merge stored states; ``finish`` turns them into final values."""
    merged = [c for n, (kind, _) in aggs.items() for c in states.merge(kind, n)]
    out = partial.groupBy(*keys).agg(*merged)
    if not finish:
        return out
    return out.select(*keys, *[states.finish(kind, n).alias(n) for n, (kind, _) in aggs.items()])


# --- sets of integers -------------------------------------------------------


def bitmap_build(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Integer set as bitmap rows ``(keys, bucket, bits)``; values are non-negative longs.

    One row covers 32768 neighbouring values, so a set never sits in one row.  Made
    for dense ids; for ids scattered over a wide range a table of distinct values is
    smaller.
    """
    v = F.col(value).cast("long")
    return df.groupBy(*keys, F.bitmap_bucket_number(v).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bits")
    )


def bitmap_add_range(df: DataFrame, value: str, start: int, stop: int) -> DataFrame:
    """Values of ``df`` and all of ``[start, stop)``."""
    return df.select(F.col(value).cast("long").alias(value)).union(df.sparkSession.range(start, stop).toDF(value))


def bitmap_or(first: DataFrame, second: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return first.unionByName(second).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_cardinality(bitmap: DataFrame, keys: Sequence[str] = (), name: str = "cardinality") -> DataFrame:
    return bitmap.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def bitmap_contains(bitmap: DataFrame, probe: DataFrame, value: str, name: str = "present") -> DataFrame:
    """Membership of every probe value: one join on the bucket, one bit test."""
    v = F.col(value).cast("long")
    at = probe.withColumns({"_wf_bucket": F.bitmap_bucket_number(v), "_wf_pos": F.bitmap_bit_position(v)})
    joined = at.join(bitmap, F.col("_wf_bucket") == F.col("bucket"), "left")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_wf_pos / 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(shiftleft(1, cast(_wf_pos % 8 as int)) as int)")
    hit = F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))
    return joined.withColumn(name, hit).drop("_wf_bucket", "_wf_pos", "bucket", "bits")


def _placed_buckets(bitmap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Buckets with ``_wf_n``, their elements, and ``_wf_before``, the elements of the buckets before: one running sum over buckets, not values."""
    sized = bitmap.withColumn("_wf_n", F.bitmap_count("bits"))
    return ordered(sized, keys, ["bucket"]).scan(_wf_before=running_sum("_wf_n", inclusive=False)).frame


def _first_bits(k: str) -> str:
    """SQL of the number of set bits among the first ``k`` of ``bits``."""
    whole = f"bitmap_count(substring(bits, 1, CAST(({k}) DIV 8 AS INT)))"
    byte = f"CAST(conv(hex(substring(bits, CAST(({k}) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return f"({whole} + coalesce(bit_count({byte} & (shiftleft(1, CAST(({k}) % 8 AS INT)) - 1)), 0))"


def bitmap_rank(bitmap: DataFrame, probe: DataFrame, value: str, keys: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Number of elements up to each probe value, from stored bitmaps: the bucket's elements before, and a popcount inside one bucket.

    A value beyond or between the buckets gets the elements of the buckets before it; null, and keys without a bitmap, get null and 0.
    """
    v = F.col(value).cast("long")
    named = [f"_wf_k{i}" for i in range(len(keys))]
    placed = _placed_buckets(bitmap, keys).select(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], F.col("bucket").alias("_wf_b"), "bits", "_wf_n", "_wf_before")
    # every value meets the last bucket that is not after its own: an as-of join of values and buckets by one scan over both
    own = probe.withColumns({"_wf_at": F.bitmap_bucket_number(v), "_wf_pos": F.bitmap_bit_position(v), "_wf_side": F.lit(1), "_wf_row": F.monotonically_increasing_id()})
    buckets = placed.select(
        *[F.col(n).alias(k) for k, n in zip(keys, named, strict=True)], F.col("_wf_b").alias("_wf_at"), F.lit(0).alias("_wf_side"), F.lit(-1).cast("bigint").alias("_wf_row"),
        F.struct(F.col("_wf_b").alias("b"), F.col("bits").alias("bits"), (F.col("_wf_before") + F.col("_wf_n")).alias("upto"), F.col("_wf_before").alias("before")).alias("_wf_set"),
    )
    both = own.withColumn("_wf_set", F.lit(None)).unionByName(buckets, allowMissingColumns=True)
    met = ordered(both, keys, ["_wf_at", "_wf_side", "_wf_row"]).scan(_wf_met=latest("_wf_set")).frame.where("_wf_side = 1")
    inside = met.withColumn("bits", F.col("_wf_met.bits"))
    rank = f"""CASE WHEN _wf_at IS NULL THEN NULL WHEN _wf_met IS NULL THEN 0L WHEN _wf_met.b < _wf_at THEN _wf_met.upto
               ELSE _wf_met.before + {_first_bits('_wf_pos + 1')} END"""
    return inside.withColumn(name, F.expr(rank)).select(*probe.columns, name)


def bitmap_select(bitmap: DataFrame, probe: DataFrame, index: str, keys: Sequence[str] = (), name: str = "selected") -> DataFrame:
    """The element at each probe index, from 0, of stored bitmaps; null beyond the last one. A binary search of popcounts inside one bucket."""
    placed = _placed_buckets(bitmap, keys)
    at = F.col(index).cast("long")
    own = probe.withColumns({"_wf_at": at, "_wf_side": F.lit(1), "_wf_row": F.monotonically_increasing_id()})
    buckets = placed.select(
        *keys, F.col("_wf_before").alias("_wf_at"), F.lit(0).alias("_wf_side"), F.lit(-1).cast("bigint").alias("_wf_row"),
        F.struct(F.col("bucket").alias("b"), F.col("bits").alias("bits"), F.col("_wf_n").alias("n"), F.col("_wf_before").alias("before")).alias("_wf_set"),
    )
    both = own.withColumn("_wf_set", F.lit(None)).unionByName(buckets, allowMissingColumns=True)
    met = ordered(both, keys, ["_wf_at", "_wf_side", "_wf_row"]).scan(_wf_met=latest("_wf_set")).frame.where("_wf_side = 1")
    inside = met.withColumn("bits", F.col("_wf_met.bits")).withColumn("_wf_left", F.col("_wf_at") - F.col("_wf_met.before"))
    # the greatest number of first bits with no more than _wf_left set ones: the element's bit comes next
    found = f"aggregate(sequence(14, 0, -1), 0, (lo, s) -> CASE WHEN {_first_bits('lo + shiftleft(1, s)')} <= _wf_left THEN lo + shiftleft(1, s) ELSE lo END)"
    value = f"CASE WHEN _wf_left >= 0 AND _wf_left < _wf_met.n THEN CASE WHEN _wf_met.b = 0 THEN 0L ELSE (_wf_met.b - 1) * 32768 + 1 + {found} END END"
    return inside.withColumn(name, F.expr(value).cast("long")).select(*probe.columns, name)


def bitmap_rank_select(bitmap: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Elements of stored bitmaps with ``rank`` = number of elements <= value; ``select(i)`` is the row with rank i+1."""
    bit = "CAST(conv(hex(substring(bits, p DIV 8 + 1, 1)), 16, 10) AS INT) & shiftleft(1, p % 8)"
    places = F.expr(f"filter(sequence(0, 8 * octet_length(bits) - 1), p -> ({bit}) <> 0)")
    each = _placed_buckets(bitmap, keys).select(*keys, "bucket", "_wf_before", F.posexplode(places).alias("_wf_i", "_wf_p"))
    value = F.when(F.col("bucket") == 0, F.lit(0)).otherwise((F.col("bucket") - 1) * 32768 + 1 + F.col("_wf_p"))  # zero has a bucket of its own
    return each.select(*keys, value.cast("long").alias(name), (F.col("_wf_before") + F.col("_wf_i") + 1).alias("rank"))
