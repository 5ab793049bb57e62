"""Quality rules with robust multivariate outliers, in DataFrame expressions only.

Every document gets a vector of transformed statistics. For each language and source the minimum covariance determinant estimate is
found by concentration steps: keep the share of documents nearest to the present centre, take their mean and covariance, scaled to be
consistent for normal data, and repeat until the group's estimate moves by less than TOLERANCE of the least floor. A document is rejected when its squared Mahalanobis distance from
its group's estimate is above the chi-square quantile of the confidence, with as many degrees of freedom as there are statistics.

Most documents have no symbol, repeated line or repeated word at all, so the spread of the nearest documents is often zero there. The floors
are lower bounds of the standard deviations (not added to them): with them alone a document goes from about 0.64 % symbols, 0.64 repeated
lines a hundred words or 7.8 % repeated words on.

Vectors are rounded to integers, so sums over any order of rows are exact and results do not depend on partitioning. The nearest share
is found from counts per distance bin, never by sorting a group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import small, stored

_BLANK = "\t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SCALE = 256
DIMS = ("v0", "v1", "v2", "v3")
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
_ROW_BITS = 30
TOLERANCE = 0.02


@dataclass(frozen=True)
class Settings:
    """share: of a group that the estimate rests on; floors: least standard deviation of each statistic; confidence: of the cut.

    steps: most concentration steps of a group; nearly all settle in five, and only those that have not go on.
    """

    share: float = 0.75
    steps: int = 12
    smallest_group: int = 50
    floors: tuple[float, ...] = (0.05, 0.6, 0.6, 0.65)
    confidence: float = 0.975

    @property
    def cut(self) -> float:
        return chi_square(self.confidence, len(DIMS))

    @property
    def consistency(self) -> float:
        """What the covariance of the nearest ``share`` of normal data is short of."""
        return self.share / chi_square_share(chi_square(self.share, len(DIMS)), len(DIMS) + 2)


def chi_square_share(x: float, degrees: int) -> float:
    """Share of a chi-square distribution of an even number of degrees up to ``x``."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square(share: float, degrees: int) -> float:
    """Quantile, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, degrees) < share else (low, middle)
    return low


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _BLANK, " " * len(_BLANK)), " "), "")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of the whole text (null: empty)."""
    rest = [c for c in docs.columns if c not in STATISTICS]
    t = F.coalesce(F.col(text), F.lit(""))
    visible = F.length(F.translate(t, " " + _BLANK, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " " + _BLANK, "")) > 0)
    first = docs.select(
        *rest, words(t).alias("_w"), visible.cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"), lines.alias("_l"),
    )
    # hash of each three-word window with its position in the low bits: one sort brings equal hashes together
    gram = f"shiftleft(shiftright(xxhash64(_w[i], _w[i + 1], _w[i + 2]), {_ROW_BITS}), {_ROW_BITS}) + i"
    second = first.select(
        *rest, "_w", "word_chars", "n_symbols", F.size("_w").cast("bigint").alias("n_words"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.expr(f"CASE WHEN size(_w) < 4 THEN array() ELSE sort_array(transform(sequence(0, size(_w) - 3), i -> {gram})) END").alias("_g"),
    )
    same = f"shiftright(x, {_ROW_BITS}) = shiftright(try_element_at(_g, i + 2), {_ROW_BITS}) OR (i > 0 AND shiftright(x, {_ROW_BITS}) = shiftright(_g[i - 1], {_ROW_BITS}))"
    near = f"transform(filter(_g, (x, i) -> {same}), x -> CAST(x & {(1 << _ROW_BITS) - 1} AS INT))"
    third = second.withColumn("_c", F.expr(near))
    # windows that share a hash prefix are compared word by word
    exact = "sort_array(transform(_c, p -> struct(concat_ws(' ', _w[p], _w[p + 1], _w[p + 2]) AS s, p AS p)))"
    fourth = third.withColumn("_e", F.expr(exact))
    twice = "x.s = try_element_at(_e, i + 2).s OR (i > 0 AND x.s = _e[i - 1].s)"
    fifth = fourth.withColumn("_p", F.expr(f"sort_array(transform(filter(_e, (x, i) -> {twice}), x -> x.p))"))
    steps = "zip_with(slice(_p, 1, size(_p) - 1), slice(_p, 2, size(_p) - 1), (a, b) -> least(3, b - a))"
    repeat = F.expr(f"CASE WHEN size(_p) = 0 THEN 0L WHEN size(_p) = 1 THEN 3L ELSE 3L + aggregate({steps}, 0L, (s, x) -> s + x) END")
    out = fifth.withColumn("n_repeat_words", repeat)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(*rest, *STATISTICS[:5], failed.alias("base_failed"))


def vector(frame: DataFrame) -> DataFrame:
    """Transformed statistics as integers of 1/SCALE: log word length, and log shares of symbols, repeated lines and repeated words."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    values = [
        F.log(c / n), F.log1p(1000 * F.col("n_symbols") / c), F.log1p(1000 * F.col("n_dup_lines") / n), F.log1p(100 * F.col("n_repeat_words") / n),
    ]
    return frame.withColumns({d: F.round(v * SCALE).cast("bigint") for d, v in zip(DIMS, values, strict=True)})


def _grouped(frame: DataFrame, smallest: int) -> DataFrame:
    """Adds group columns a, b: language and source, or a rest group where either has too few usable rows. Nulls group together."""
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    tagged = frame.withColumn("a0", tag("lang")).withColumn("b0", tag("source"))
    sizes = tagged.groupBy("a0", "b0").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("n"))
    sizes = sizes.withColumn("b", F.when(F.col("n") >= smallest, F.col("b0")).otherwise("rest"))
    left = sizes.groupBy("a0", "b").agg(F.sum("n").alias("m"))
    names = sizes.join(left, ["a0", "b"]).select("a0", "b0", F.when(F.col("m") >= smallest, F.col("a0")).otherwise("rest").alias("a"), "b")
    names = stored(names, "groups")
    return tagged.join(small(names, names.count()), ["a0", "b0"]).drop("a0", "b0")


def _medians(usable: DataFrame) -> DataFrame:
    """Median of each dimension per group, exact, from counts per value."""
    stack = ", ".join(f"{k}, {d}" for k, d in enumerate(DIMS))
    counts = usable.selectExpr("a", "b", f"stack({len(DIMS)}, {stack}) AS (k, v)").groupBy("a", "b", "k", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("a", "b", "k")
    placed = counts.withColumn("_upto", F.sum("n").over(w.orderBy("v"))).withColumn("_all", F.sum("n").over(w))
    middle = placed.where(F.col("_upto") * 2 >= F.col("_all")).groupBy("a", "b", "k").agg(F.min("v").alias("v"))
    return middle.groupBy("a", "b").agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"c{k}") for k in range(len(DIMS))])


def _root(cov, floors: tuple[float, ...]) -> dict[str, Column]:
    """Lower Cholesky factor l{i}{j} of the covariance ``cov(i, j)``, its diagonal not below the floors."""
    low: dict[tuple[int, int], Column] = {}
    for i in range(len(DIMS)):
        for j in range(i + 1):
            rest = cov(i, j)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            low[i, j] = F.sqrt(F.greatest(rest, F.lit((floors[i] * SCALE) ** 2))) if i == j else rest / F.col(f"l{j}{j}")
    return {f"l{i}{j}": c for (i, j), c in low.items()}


def _distance(frame: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance d2 from centre c* and factor l*."""
    for i, d in enumerate(DIMS):
        rest = F.col(d) - F.col(f"c{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"z{j}")
        frame = frame.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(DIMS))), F.lit(0.0))
    return frame.withColumn("d2", total).drop(*[f"z{i}" for i in range(len(DIMS))])


def estimates(usable: DataFrame, s: Settings) -> DataFrame:
    """Minimum covariance determinant estimate per group (a, b): centre c* and factor l*."""
    size = len(DIMS)
    start = _medians(usable)
    for i in range(size):
        for j in range(i + 1):
            start = start.withColumn(f"l{i}{j}", F.lit(s.floors[i] * SCALE if i == j else 0.0))
    now, settled = stored(start, "mcd"), None
    for _ in range(s.steps):
        groups = now.count()
        if not groups:
            break
        placed = _distance(usable.join(small(now, groups), ["a", "b"])).withColumn("bin", F.floor(64 * F.log2(1 + F.col("d2"))))
        counts = placed.groupBy("a", "b", "bin").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("a", "b")
        upto = counts.withColumn("_upto", F.sum("n").over(w.orderBy("bin"))).withColumn("_all", F.sum("n").over(w))
        edge = upto.where(F.col("_upto") >= s.share * F.col("_all")).groupBy("a", "b").agg(F.min("bin").alias("edge"))
        nearest = placed.join(small(edge, groups), ["a", "b"]).where(F.col("bin") <= F.col("edge"))
        pairs = [(i, j) for i in range(size) for j in range(i + 1)]
        sums = nearest.groupBy("a", "b").agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            *[F.sum(d).cast("double").alias(f"s{i}") for i, d in enumerate(DIMS)],
            *[F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).cast("double").alias(f"p{i}{j}") for i, j in pairs],
        )
        cov = lambda i, j: s.consistency * (F.col(f"p{i}{j}") / F.col("n") - F.col(f"c{i}") * F.col(f"c{j}"))
        fitted = sums.withColumns({f"c{i}": F.col(f"s{i}") / F.col("n") for i in range(size)})
        for name, column in _root(cov, s.floors).items():
            fitted = fitted.withColumn(name, column)
        names = [*[f"c{i}" for i in range(size)], *[f"l{i}{j}" for i, j in pairs]]
        before = now.select("a", "b", *[F.col(x).alias(f"{x}_") for x in names])
        moved = F.expr(" OR ".join(f"abs({x} - {x}_) > {TOLERANCE * min(s.floors) * SCALE}" for x in names)).alias("_moved")
        fresh = stored(fitted.select("a", "b", *names).join(before, ["a", "b"]).select("a", "b", *names, moved), "mcd")
        ended = fresh.where(~F.col("_moved")).drop("_moved")
        settled = ended if settled is None else settled.union(ended)
        now = fresh.where("_moved").drop("_moved")
    return now if settled is None else settled.union(now)


def judge(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """All columns of ``docs`` but the text, the base statistics, base_failed, d2 and kept.

    Documents that fail a base rule are not kept and shape no estimate; d2 is null for them. Rows of a language and source with fewer
    than ``smallest_group`` usable rows share a rest group; where even that is smaller, nothing is rejected. Null languages and sources
    form groups of their own, a null text has no words and fails, repeated rows count as often as they come, an empty table stays empty.
    """
    s = settings or Settings()
    own = [c for c in docs.columns if c not in ("text", *STATISTICS, "d2", "kept")]
    packed = docs.select(F.struct(*own).alias("_wf_row"), "text", "lang", "source")
    table = stored(vector(statistics(packed).drop("text")), "statistics")
    grouped = _grouped(table, s.smallest_group)
    usable = grouped.where(~F.col("base_failed")).select("a", "b", *DIMS)
    sizes = usable.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_size"))
    found = stored(estimates(usable, s).join(sizes, ["a", "b"]), "mcd")
    placed = _distance(grouped.join(small(found, found.count()), ["a", "b"], "left"))
    d2 = F.when(~F.col("base_failed") & (F.col("_size") >= s.smallest_group), F.col("d2"))
    out = placed.withColumn("d2", d2).withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= s.cut))
    return out.select("_wf_row.*", *STATISTICS, "d2", "kept")
