"""Spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced character turns one into the other. The shorter word of a pair (either, if they
are equally long) contributes two disjoint chunks, its halves; the other contributes its positional grams of those lengths. One edit
touches at most one of the chunks, so the other one is a gram of the second word, and it lies where it was or, behind the edit, one place
further on if the second word is longer. So of the grams within a shift of one, only the prefix and the suffix of the chunks'
lengths can meet them, and only these are sent. What meets is verified by edit distance.

A chunk that many words share would bring all of them together. Its words are dealt out further by the same rule: if the chunk is intact,
the remainders of the two words are one edit apart, and one of the two chunks of the remainder is intact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import stored

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["size", "part", "chunk", "sub", "subchunk"]


@dataclass(frozen=True)
class Settings:
    """min_chars, min_count: of a word; factor: how many times as frequent a word's form is; crowded: words of a chunk that stay together."""

    min_chars: int = 6
    min_count: int = 5
    factor: int = 5
    crowded: int = 24


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, run: every maximal run of letters of every whole text, A-Z lower-cased. Null and empty texts have none."""
    found = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run"))


def vocabulary(words: DataFrame, word: str | Column, settings: Settings | None = None) -> DataFrame:
    """word, n: the words of at least ``min_chars`` characters that occur at least ``min_count`` times; null words don't count."""
    s = settings or Settings()
    counted = words.select((F.col(word) if isinstance(word, str) else word).alias("word")).where(F.length("word") >= s.min_chars)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= s.min_count)


def _exploded(frame: DataFrame, rows: str) -> DataFrame:
    return frame.select("*", F.explode(F.expr(rows)).alias("_x")).select(*frame.columns, "_x.*")


def _chunks(vocab: DataFrame) -> DataFrame:
    """Each word's two halves: its length, which half (part), the half (chunk) and what remains."""
    rows = """array(
        named_struct('size', length(word), 'part', 0, 'chunk', left(word, length(word) div 2), 'remainder', substring(word, 1 + length(word) div 2)),
        named_struct('size', length(word), 'part', 1, 'chunk', substring(word, 1 + length(word) div 2), 'remainder', left(word, length(word) div 2)))"""
    return _exploded(vocab, rows)


def _grams(vocab: DataFrame, least: int) -> DataFrame:
    """The grams of each word that can be a chunk of a word as long or one shorter."""
    sizes = f"filter(array(length(word), length(word) - 1), z -> z >= {least})"
    rows = f"""flatten(transform({sizes}, z -> array(
        named_struct('size', CAST(z AS INT), 'part', 0, 'chunk', left(word, z div 2), 'remainder', substring(word, 1 + z div 2)),
        named_struct('size', CAST(z AS INT), 'part', 1, 'chunk', right(word, z - z div 2), 'remainder', left(word, length(word) - z + z div 2)))))"""
    return _exploded(vocab, rows)


def _dealt(rows: DataFrame, crowds: DataFrame, own: bool) -> DataFrame:
    """Adds sub and subchunk: for rows of crowded chunks one row per chunk of the remainder; -1 and the empty text for others."""
    half = "CASE part WHEN 0 THEN (size - size div 2) div 2 ELSE size div 2 div 2 END"
    rest = "CASE part WHEN 0 THEN size - size div 2 ELSE size div 2 END"
    last = "substring(remainder, 1 + _half)" if own else "right(remainder, _rest - _half)"
    subs = f"""CASE WHEN crowd THEN array(named_struct('sub', 0, 'subchunk', left(remainder, _half)), named_struct('sub', 1, 'subchunk', {last}))
               ELSE array(named_struct('sub', -1, 'subchunk', '')) END"""
    marked = rows.join(crowds, ["size", "part", "chunk"], "left").withColumns({"_half": F.expr(f"CAST({half} AS INT)"), "_rest": F.expr(f"CAST({rest} AS INT)")})
    return _exploded(marked, subs).select("word", "n", *_KEY)


def near_pairs(vocab: DataFrame, settings: Settings | None = None) -> DataFrame:
    """a, na, b, nb: every two words of ``vocab`` (word, n: different words) that are exactly one edit apart, once."""
    s = settings or Settings()
    mine, theirs = _chunks(vocab), _grams(vocab, 2)
    crowds = mine.groupBy("size", "part", "chunk").agg((F.count(F.lit(1)) > s.crowded).alias("crowd")).where("crowd")
    left = _dealt(mine, crowds, True).select(F.col("word").alias("a"), F.col("n").alias("na"), *_KEY)
    right = _dealt(theirs, crowds, False).select(F.col("word").alias("b"), F.col("n").alias("nb"), *_KEY)
    # words of one length meet in both roles
    met = left.join(right, _KEY).where("a <> b AND (length(b) > length(a) OR a < b) AND levenshtein(a, b, 1) = 1")
    return met.select("a", "na", "b", "nb").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the chain of forms from each word of ``forms`` (word, form; no cycles), by pointer doubling."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = stored(now.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(vocab: DataFrame, settings: Settings | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``vocab`` (word, n: different words of ``min_chars`` characters or more).

    n_near is the number of near words. form is the most frequent of them (ties: the first in code-point order) if it is at least
    ``factor`` times as frequent as the word, form_n its n; else both are null. root is where following the forms ends, the word itself if it
    has none. Frequencies grow along a chain, so it ends. An empty vocabulary stays empty.
    """
    s = settings or Settings()
    vocab = stored(vocab.select("word", F.col("n").cast("bigint").alias("n")), "words")
    pairs = stored(near_pairs(vocab, s), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")).union(pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    joined = vocab.join(best, "word", "left").withColumn("_form_n", -F.col("best.m"))
    chosen = F.col("_form_n") >= s.factor * F.col("n")
    formed = joined.select(
        "word", F.when(chosen, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(chosen, F.col("_form_n")).alias("form_n")
    )
    formed = stored(formed, "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
