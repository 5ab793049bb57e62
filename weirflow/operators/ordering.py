"""Ordered scans (running values, previous row, row index) that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(seq)`` puts all rows of one key in one
task, and with no key at all it puts the whole table there.  Here a group larger
than ``split_rows`` is cut along its order column into blocks:

1. each (key, block) is scanned locally by an ordinary window,
2. each (key, block) is also reduced to one summary row (partial aggregation),
3. the summary rows - a bounded number per key - are scanned to give every block
   the value it inherits from the blocks before it,
4. the inherited value is joined back and combined with the local one.

Keys below the limit keep the single-shuffle window.  All values offered here
(sum, count, max, min, previous, latest) combine this way without loss.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

SPLIT_ROWS_CONF = "spark.weirflow.splitRows"
DEFAULT_SPLIT_ROWS = 4_000_000
# A key is split only if it holds more than 1/MAX_PARTS of all rows (so at most
# MAX_PARTS keys are split) and into at most MAX_PARTS blocks.
MAX_PARTS = 10_000
BROADCAST_ROWS = 1_000_000
SAMPLE_PER_PART = 1_000
TUPLES_PER_PART = 60
_BLOCK = "_wf_block"


@dataclass(frozen=True)
class Running:
    kind: str
    value: Column
    inclusive: bool = True


def running_sum(value: Column | str, inclusive: bool = True) -> Running:
    """Sum of the rows up to (and with ``inclusive`` including) the current one; 0 before any."""
    return Running("sum", _col(value), inclusive)


def running_count(inclusive: bool = True) -> Running:
    return Running("sum", F.lit(1).cast("long"), inclusive)


def running_max(value: Column | str, inclusive: bool = True) -> Running:
    return Running("max", _col(value), inclusive)


def running_min(value: Column | str, inclusive: bool = True) -> Running:
    return Running("min", _col(value), inclusive)


def previous(value: Column | str) -> Running:
    """Value of the row before, null on the first row of the key."""
    return Running("previous", _col(value), False)


def latest(value: Column | str, inclusive: bool = True) -> Running:
    """Last non-null value so far."""
    return Running("latest", _col(value), inclusive)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_rows_of(df: DataFrame, split_rows: int | None) -> int:
    if split_rows:
        return split_rows
    return int(df.sparkSession.conf.get(SPLIT_ROWS_CONF, str(DEFAULT_SPLIT_ROWS)))


def as_number(df: DataFrame, name: str) -> Column:
    """Order column as a number: itself, or microseconds for a point in time."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name)


def _cut_points(df: DataFrame, order: str, parts: int, rows: int) -> list[float]:
    """Values that cut ``df`` into about ``parts`` equal pieces (at most ``parts`` numbers); a value with many rows comes several times.

    They only decide where blocks begin, so like a range partitioner they are read
    off a sample; any values give the same result.
    """
    if parts < 2:
        return []
    probs = [i / parts for i in range(1, parts)]
    wanted = SAMPLE_PER_PART * parts
    seen = df.sample(wanted / rows, seed=1) if rows > 4 * wanted else df
    found = seen.select(
        F.percentile_approx(as_number(df, order), probs, max(10_000, 10 * parts)).alias("p")
    ).first()["p"]
    return sorted(float(x) for x in found or [])


@dataclass(frozen=True)
class Cuts:
    """Where blocks begin: numbers of the first order column, or (``rows``, of ``schema``) whole order tuples where its values are too few."""

    numbers: tuple[float, ...] = ()
    rows: tuple = ()
    schema: StructType | None = None

    def __len__(self) -> int:
        return len(self.rows) or len(self.numbers)


def _cuts(df: DataFrame, order: Sequence[str], parts: int, rows: int) -> Cuts:
    """About ``parts`` equal pieces. A value that alone fills two pieces shows as equal cut points: then the whole tuple is cut on."""
    numbers = _cut_points(df, order[0], parts, rows)
    wide = len(set(numbers)) < len(numbers) or parts > 1 and not numbers
    if not wide or len(order) == 1:
        return Cuts(tuple(sorted(set(numbers))))
    # a bounded sample is sorted in one task, as a range partitioner does on the driver; any cuts give the same result
    wanted = TUPLES_PER_PART * parts
    seen = df.sample(min(1.0, wanted / rows), seed=1) if rows > 4 * wanted else df
    at = F.struct(*order)
    if rows <= 4 * wanted:
        seen = seen.orderBy(F.xxhash64(*order)).limit(wanted)
    sample = seen.agg(F.sort_array(F.collect_list(at)).alias("s"))
    picks = F.expr(f"array_distinct(transform(sequence(1, {parts - 1}), i -> get(s, CAST(i * size(s) div {parts} AS INT))))")
    found = [r for r in (sample.select(picks.alias("p")).first()["p"] or []) if r is not None]
    return Cuts(rows=tuple(tuple(r) for r in found), schema=df.select(*order).schema)


def _tuple_bucket(df: DataFrame, order: Sequence[str], cuts: Cuts, name: str, of: Column | None) -> DataFrame:
    """Block number from 1 by binary search in the sorted cut tuples, at most MAX_PARTS of them."""
    steps = len(cuts).bit_length()
    table = df.sparkSession.createDataFrame([([*cuts.rows],)], StructType([StructField("_wf_cuts", ArrayType(cuts.schema))]))
    at = f"struct({', '.join(f'`{c}`' for c in order)})"
    probe = "lo + shiftleft(1, s) - 1"
    ahead = f"CASE WHEN {probe} < size(_wf_cuts) AND get(_wf_cuts, {probe}) <= _wf_tuple THEN lo + shiftleft(1, s) ELSE lo END"
    found = F.expr(f"aggregate(sequence({steps - 1}, 0, -1), 0, (lo, s) -> {ahead})") + 1
    # one row of bounded size
    joined = df.withColumn("_wf_tuple", F.expr(at)).join(F.broadcast(table))
    return joined.withColumn(name, found if of is None else F.when(of, found)).drop("_wf_tuple", "_wf_cuts")


def _with_bucket(df: DataFrame, order: Sequence[str], cuts: Cuts, name: str, of: Column | None = None) -> DataFrame:
    """Block number from 1; rows where ``of`` is not true get none."""
    if not len(cuts):
        return df.withColumn(name, F.lit(1))
    if cuts.rows:
        return _tuple_bucket(df, order, cuts, name, of)
    splits, order = [float("-inf"), *cuts.numbers, float("inf")], order[0]
    # nulls come first, as in a window's order
    number = F.coalesce(as_number(df, order).cast("double"), F.lit(float("-inf")))
    numbered = df.withColumn("_wf_order", number if of is None else F.when(of, number))
    bucketed = Bucketizer(
        splits=splits, inputCol="_wf_order", outputCol="_wf_bucket", handleInvalid="keep"
    ).transform(numbered)
    return bucketed.withColumn(name, F.col("_wf_bucket").cast("int") + 1).drop("_wf_order", "_wf_bucket")


class Ordered:
    """A frame with a key and an order; ``scan`` adds ordered values, ``map`` rewrites rows."""

    def __init__(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int, place: Callable[[DataFrame], DataFrame] | None = None
    ):
        self._df, self._keys, self._order, self._blocks = df, list(keys), list(order), blocks
        # how to lay rows out before the first scan; later scans find them in place
        self._place = place

    @property
    def frame(self) -> DataFrame:
        return self._df.drop(_BLOCK)

    def map(self, step: Callable[[DataFrame], DataFrame]) -> "Ordered":
        """Row-wise change (``withColumn``, ``filter``); key and order columns must stay."""
        return Ordered(step(self._df), self._keys, self._order, self._blocks, self._place)

    def scan(self, **columns: Running) -> "Ordered":
        if self._blocks == 0:
            window = Window.partitionBy(*self._keys).orderBy(*self._order)
            out = self._placed().withColumns({n: _local(r, window, True) for n, r in columns.items()})
            return Ordered(out, self._keys, self._order, 0)
        return Ordered(self._block_scan(columns), self._keys, self._order, self._blocks)

    def _placed(self) -> DataFrame:
        return self._place(self._df) if self._place else self._df

    def _block_scan(self, columns: dict[str, Running]) -> DataFrame:
        df, keys = self._df, self._keys
        window = Window.partitionBy(*keys, _BLOCK).orderBy(*self._order)
        local = self._placed().withColumns({f"_wf_l_{n}": _local(r, window, False) for n, r in columns.items()})

        at = F.struct(*[F.col(c) for c in self._order])
        # taken from rows not laid out yet, where it combines before its own small shuffle;
        # unfiltered without keys, so that a further scan can reuse the exchange of this one
        split = df.where(F.col(_BLOCK) > 0) if keys else df
        summary = split.groupBy(*keys, _BLOCK).agg(
            *[_summary(r, at).alias(f"_wf_s_{n}") for n, r in columns.items()]
        )
        before = Window.partitionBy(*keys).orderBy(_BLOCK)
        inherited = summary.select(
            *[F.col(k).alias(f"_wf_k_{i}") for i, k in enumerate(keys)],
            F.col(_BLOCK).alias("_wf_b"),
            *[_inherited(r, f"_wf_s_{n}", before).alias(f"_wf_i_{n}") for n, r in columns.items()],
        )
        if not keys or self._blocks <= BROADCAST_ROWS:
            # rows <= hot keys x blocks, checked when the frame was cut
            inherited = F.broadcast(inherited)
        on = F.col(_BLOCK) == F.col("_wf_b")
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_wf_k_{i}"))
        joined = local.join(inherited, on, "left")
        merged = joined.withColumns(
            {n: _combined(r, F.col(f"_wf_i_{n}"), F.col(f"_wf_l_{n}")) for n, r in columns.items()}
        )
        return merged.select(*df.columns, *[n for n in columns if n not in df.columns])


def ordered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split_rows: int | None = None
) -> Ordered:
    """Prepare ``df`` for scans per ``keys`` in ``order``.

    ``order[0]`` must be a number or a point in time; blocks are cut on it, and on
    the whole order where one of its values holds too many rows; nulls come first.  Runs a counting job over the
    key columns, and a few more small ones when there is something to split.
    """
    limit = split_rows_of(df, split_rows)
    keys, order = list(keys), list(order)
    if not keys:
        rows = df.count()
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = min(MAX_PARTS, max(cores, -(-rows // limit)))
        cuts = _cuts(df, order, parts, max(rows, 1))
        # numbered from 0: the block is the partition number, which windows over it recognize
        tagged = _with_bucket(df, order, cuts, _BLOCK).withColumn(_BLOCK, F.col(_BLOCK) - 1)
        blocks = len(cuts) + 1
        # one block per task, whatever the session's number of shuffle partitions
        return Ordered(tagged, keys, order, blocks, lambda d: d.repartitionById(blocks, F.col(_BLOCK)))

    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_wf_n"))
    total, biggest = per_key.agg(F.sum("_wf_n"), F.max("_wf_n")).first()
    if not total or biggest <= limit:
        return Ordered(df, keys, order, 0, _enough_tasks(df, total or 0, limit, keys))
    limit = max(limit, -(-total // MAX_PARTS))
    # more than total/MAX_PARTS rows each, so fewer than MAX_PARTS keys come to the driver
    found = per_key.where(F.col("_wf_n") > limit).collect()
    if not found:
        return Ordered(df, keys, order, 0, _enough_tasks(df, total, limit, keys))
    hot_rows = sum(r["_wf_n"] for r in found)
    named = [F.col(k).alias(f"_wf_h_{i}") for i, k in enumerate(keys)]
    hot = df.sparkSession.createDataFrame([tuple(r)[:-1] for r in found], df.select(*named).schema)
    hot = hot.withColumn("_wf_hot", F.lit(True))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_wf_h_{i}"))
    flagged = df.join(F.broadcast(hot), on, "left").drop(*[f"_wf_h_{i}" for i in range(len(keys))])
    parts = min(MAX_PARTS, max(2, -(-hot_rows // limit)))
    cuts = _cuts(flagged.where("_wf_hot"), order, parts, hot_rows)
    cut = _with_bucket(flagged, order, cuts, "_wf_cut", F.col("_wf_hot"))
    tagged = cut.withColumn(
        _BLOCK, F.when(F.col("_wf_hot"), F.col("_wf_cut")).otherwise(F.lit(0))
    ).drop("_wf_hot", "_wf_cut")
    blocks = len(found) * (len(cuts) + 1)
    return Ordered(tagged, keys, order, blocks, _enough_tasks(df, total, limit, [*keys, _BLOCK]))


def _enough_tasks(df: DataFrame, rows: int, limit: int, by: Sequence[str]) -> Callable[[DataFrame], DataFrame] | None:
    """Ask for about one task per ``limit`` rows where the session's setting would give fewer."""
    wanted = min(MAX_PARTS, -(-rows // limit))
    if wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return None
    return lambda d: d.repartition(wanted, *by)


def _frame(window: Window, inclusive: bool):
    return window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def _local(r: Running, window: Window, final: bool) -> Column:
    """Value inside one window group; ``final`` gives the finished value."""
    over = _frame(window, r.inclusive)
    if r.kind == "sum":
        return F.coalesce(F.sum(r.value).over(over), F.lit(0))
    if r.kind == "max":
        return F.max(r.value).over(over)
    if r.kind == "min":
        return F.min(r.value).over(over)
    if r.kind == "latest":
        return F.last(r.value, ignorenulls=True).over(over)
    boxed = F.lag(F.struct(r.value.alias("v"))).over(window)
    return boxed["v"] if final else boxed


def _summary(r: Running, at: Column) -> Column:
    if r.kind == "sum":
        return F.sum(r.value)
    if r.kind == "max":
        return F.max(r.value)
    if r.kind == "min":
        return F.min(r.value)
    if r.kind == "latest":
        return F.max_by(r.value, F.when(r.value.isNotNull(), at))
    return F.max_by(F.struct(r.value.alias("v")), at)


def _inherited(r: Running, name: str, before: Window) -> Column:
    over = before.rowsBetween(Window.unboundedPreceding, -1)
    if r.kind == "sum":
        return F.sum(name).over(over)
    if r.kind == "max":
        return F.max(name).over(over)
    if r.kind == "min":
        return F.min(name).over(over)
    if r.kind == "latest":
        return F.last(name, ignorenulls=True).over(over)
    return F.lag(name).over(before)


def _combined(r: Running, inherited: Column, local: Column) -> Column:
    if r.kind == "sum":
        return F.coalesce(inherited, F.lit(0)) + local
    if r.kind == "max":
        return F.greatest(inherited, local)
    if r.kind == "min":
        return F.least(inherited, local)
    if r.kind == "latest":
        return F.coalesce(local, inherited)
    return F.coalesce(local, inherited)["v"]


def row_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n", split_rows: int | None = None
) -> DataFrame:
    """1-based position per key in ``order`` (global when ``keys`` is empty)."""
    return ordered(df, keys, order, split_rows).scan(**{name: running_count()}).frame
