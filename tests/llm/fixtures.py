"""Small corpora and brute-force helpers."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, ids=None, lang="en", source="s"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words_of(rng: random.Random, n: int, alphabet="ab", longest=3):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))) for _ in range(n)]


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


EDGE = [None, "", " \n\t ", "word", "é漢字😀\x00 z", "a  b\n\nc ﬁ "]
