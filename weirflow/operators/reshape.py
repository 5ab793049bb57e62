"""Stateless row operators; all of them work the same on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.session import checkpointed


def map_project(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """One row in, one row out."""
    return df.select(*[(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


# The characters a separator pattern stands for.
_SEPARATOR_CHARS = {r"\s": " \t\n\x0b\f\r"}


def tokens(text: Column | str, sep: str = " ") -> Column:
    """Array of tokens; inner empty tokens stay, trailing ones go, empty text gives one empty token.

    ``sep`` is a regular expression for one separator.  Text that holds nothing
    but separators gives no token at all.
    """
    c = F.col(text) if isinstance(text, str) else text
    if sep == " ":
        trimmed = F.rtrim(c)  # spaces only; much faster than a trim with a given character set
    elif sep in _SEPARATOR_CHARS:
        trimmed = F.rtrim(c, F.lit(_SEPARATOR_CHARS[sep]))
    else:
        trimmed = F.regexp_replace(c, f"({sep})+$", "")
    only_separators = (trimmed == "") & (c != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(trimmed, sep))


def flat_map_split(df: DataFrame, text: str, sep: str = " ", keep: Sequence[str] = (), word: str = "word") -> DataFrame:
    """One row per token of ``text``; see :func:`tokens`."""
    return df.select(*keep, F.explode(tokens(text, sep)).alias(word))


def filter_not_contains(df: DataFrame, col: str, needle: str = "0") -> DataFrame:
    return df.where(~F.contains(F.col(col).cast("string"), F.lit(needle)))


def flat_filter_not_contains(df: DataFrame, col: str, needle: str = "0") -> DataFrame:
    """Same rows as :func:`filter_not_contains`, written as a row -> 0..1 rows expansion."""
    row = F.struct(*df.columns)
    kept = F.when(F.contains(F.col(col).cast("string"), F.lit(needle)), F.array()).otherwise(F.array(row))
    return df.select(F.explode(kept).alias("r")).select("r.*")


def select_where(df: DataFrame, columns: Sequence[str], condition: str) -> DataFrame:
    """Fluent form of ``select columns from df where condition``."""
    return df.where(condition).select(*columns)


def select_where_sql(spark: SparkSession, view: str, columns: Sequence[str], condition: str) -> DataFrame:
    return spark.sql(f"SELECT {', '.join(columns)} FROM {view} WHERE {condition}")


def side_output_split(df: DataFrame, tags: dict[str, Column], default: str = "main", tag: str = "tag") -> DataFrame:
    """Mark each row with the first matching tag, ``default`` when none matches.

    One pass over the input; readers take their output with ``where(tag == ...)``.
    """
    mark = F.lit(default)
    for name, condition in reversed(list(tags.items())):
        mark = F.when(condition, F.lit(name)).otherwise(mark)
    return df.withColumn(tag, mark)


def split_select(tagged: DataFrame, *names: str, tag: str = "tag") -> DataFrame:
    """Older two-step form: pick the outputs with the given names."""
    return tagged.where(F.col(tag).isin(*names)).drop(tag)


def connect_comap(
    left: DataFrame,
    right: DataFrame,
    map_left: Callable[[DataFrame], DataFrame],
    map_right: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two inputs of different type, a function per side, one output type."""
    return map_left(left).unionByName(map_right(right))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by position; duplicates stay."""
    out = first
    for df in others:
        out = out.union(df)
    return out


def register_split_udtf(spark: SparkSession, name: str = "my_split", sep: str = " ") -> str:
    """Register a table function ``name(line) -> (word, cnt)`` for use in SQL.

    It shows the table-function API; :func:`flat_map_split` is the fast form.
    """

    @F.udtf(returnType="word string, cnt int")
    class Split:
        def eval(self, line: str):
            words = (line or "").split(sep)
            while len(words) > 0 and words[-1] == "" and line:
                words.pop()
            for word in words if line is not None else ():
                yield word, 1

    spark.udtf.register(name, Split)
    return name


def udtf_split_count(df: DataFrame, text: str, names: tuple[str, str] = ("单词", "数量"), sep: str = " ") -> DataFrame:
    """Table function, then group and sum, with renamed output columns."""
    words = flat_map_split(df, text, sep).select(F.col("word"), F.lit(1).cast("long").alias("cnt"))
    return words.groupBy(F.col("word").alias(names[0])).agg(F.sum("cnt").alias(names[1]))


def map_with_lifecycle(
    df: DataFrame,
    schema: str | T.StructType,
    open_task: Callable[[], object],
    process: Callable[[object, pd.DataFrame], pd.DataFrame],
    close_task: Callable[[object], None] = lambda resource: None,
) -> DataFrame:
    """Open a resource once per task, map batches with it, close it at the end or on failure."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        resource = open_task()
        try:
            for batch in batches:
                yield process(resource, batch)
        finally:
            close_task(resource)

    return df.mapInPandas(run, schema)


def iterate_until(
    df: DataFrame, step: dict[str, Column | str], keep_going: Column | str, unroll: int = 8, rounds: str = "rounds"
) -> DataFrame:
    """Apply ``step`` to every row until ``keep_going`` is false on the new values, then emit it.

    The body always runs once; a condition that is unknown (null) ends the loop.  ``unroll`` steps go into one Spark stage; rows not
    finished after them form the (smaller) input of the next round, which starts
    from a reliable checkpoint.  No limit on the number of rounds.
    """
    as_col = lambda c: F.expr(c) if isinstance(c, str) else c
    go = F.coalesce(as_col(keep_going), F.lit(False))
    stepped = {n: as_col(c) for n, c in step.items()}
    active = df.withColumns({"_wf_go": F.lit(True), rounds: F.lit(0).cast("long")})
    done = None
    while True:
        for _ in range(unroll):
            running = F.col("_wf_go")
            moved = {n: F.when(running, c).otherwise(F.col(n)) for n, c in stepped.items()}
            moved[rounds] = F.when(running, F.col(rounds) + 1).otherwise(F.col(rounds))
            active = active.withColumns(moved).withColumn("_wf_go", running & go)
        active = checkpointed(active)
        finished = active.where(~F.col("_wf_go"))
        done = finished if done is None else done.unionByName(finished)
        active = active.where("_wf_go")
        if active.isEmpty():
            return done.drop("_wf_go")


def iterate_until_sql(spark: SparkSession, view: str, value: str, amount: int = 3) -> DataFrame:
    """The subtract-until-not-positive loop as one recursive query (Spark's recursion limits apply)."""
    return spark.sql(
        f"""
        WITH RECURSIVE loop(start_value, v) AS (
          SELECT {value}, CASE WHEN {value} > 0 THEN {value} - {amount} ELSE {value} END FROM {view}
          UNION ALL
          SELECT start_value, v - {amount} FROM loop WHERE v > 0
        )
        SELECT start_value, v FROM loop WHERE v <= 0
        """
    )


def parse_json_fields(df: DataFrame, text: str, schema: str, fields: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``text`` once with a declared schema and pick ``fields`` (output name -> expression on ``j``)."""
    parsed = df.select(*keep, F.from_json(text, schema).alias("j"))
    return parsed.select(*keep, *[F.expr(e).alias(n) for n, e in fields.items()])


def decode_message_kv(
    df: DataFrame, key: str = "key", value: str = "value", key_as: str | None = "key", value_as: str | None = "value", form: str = "columns"
) -> DataFrame:
    """UTF-8 decode of key and value; null stays null; a side named ``None`` is left out.

    ``form`` is ``columns`` or ``map`` (one map column ``message``).
    """
    sides = [(n, F.decode(F.col(c), "UTF-8")) for n, c in ((key_as, key), (value_as, value)) if n]
    rest = [c for c in df.columns if c not in (key, value)]
    if form == "map":
        return df.select(*rest, F.create_map(*[x for n, c in sides for x in (F.lit(n), c)]).alias("message"))
    return df.select(*rest, *[c.alias(n) for n, c in sides])


def encode_message_kv(df: DataFrame, key: str | None, value: str | None) -> DataFrame:
    """Envelope columns ``key`` and ``value`` as UTF-8 bytes; a missing side becomes null."""
    enc = lambda c: F.encode(F.col(c).cast("string"), "UTF-8") if c else F.lit(None).cast("binary")
    rest = [c for c in df.columns if c not in (key, value, "key", "value")]
    return df.select(*rest, enc(key).alias("key"), enc(value).alias("value"))


def parse_delimited_record(
    df: DataFrame, line: str, fields: Sequence[int] = (0, 2, 4, 6), sep: str = ",", quote: str = "'", out_sep: str = "\t", name: str = "record", raw_fields: Sequence[int] = (6,)
) -> DataFrame:
    """Pick fields of a delimited line, strip quotes (except in ``raw_fields``), join with ``out_sep``."""
    parts = F.split(F.col(line), sep)
    picked = [F.get(parts, F.lit(i)) for i in fields]
    clean = [p if i in raw_fields else F.replace(p, F.lit(quote), F.lit("")) for i, p in zip(fields, picked)]
    return df.withColumn(name, F.concat_ws(out_sep, *clean))
