"""One registered query per corpus operator, on the whole of its tables, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import chosenpath, decontam, langid, lexical, outliers, pieces, quality, records, sharding, simhash, spelling, suffixdedup, windowdedup
from weirflow.llm.common import held_out
from weirflow.session import load, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, load(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def piece_model() -> pieces.ModelFile:
    return pieces.ModelFile.read(public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """decoded_sha256 is of the text that the ids decode to; exact says whether that is the input."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.round_trip(docs, piece_model())
    return coded.select("doc_id", "n_pieces", F.xxhash64("ids").alias("ids_hash"), "decoded_sha256", "exact")


OP8_SQL = r"""
WITH iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
items AS (SELECT item_id, w, len(w) AS n, least(len(w), 10) AS m FROM iw WHERE len(w) > 0),
win AS (SELECT item_id, m, array_to_string(list_slice(w, s + 1, s + m), ' ') AS span
        FROM (SELECT item_id, w, m, unnest(range(0, n - m + 1)) AS s FROM items)),
dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
       FROM documents),
places AS (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w))) AS s FROM dw),
hits AS (SELECT p.doc_id, p.s, l.m, array_to_string(list_slice(p.w, p.s + 1, p.s + l.m), ' ') AS span
         FROM places p, (SELECT DISTINCT m FROM win) l WHERE p.s + l.m <= p.n),
found AS (SELECT h.doc_id, h.s, h.m, w.item_id FROM hits h JOIN win w USING (span) WHERE h.m = w.m),
cover AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS pos FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


@query("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contamination(docs, load(spark, sf_dir, "benchmark")).drop("text")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return outliers.judge(docs).drop("lang", "source")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(list_slice(w, s + 1, s + 20), ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = windowdedup.deduplicate(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_hilbert_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return sharding.shards(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def byte_tokenizer() -> str:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@query("op2_token_records")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    files = records.write(load(spark, sf_dir, "documents").select("doc_id", "text"), path, byte_tokenizer())
    return records.read(spark, path, files)


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixdedup.deduplicate(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_PLAIN = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# letters outside ASCII as one byte each: DuckDB's levenshtein counts bytes
_ONE_BYTE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"
OP13_SQL = rf"""
WITH RECURSIVE step AS (SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
              UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_PLAIN.format('text')}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
         GROUP BY doc_id, w),
bytes AS (SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''),
          lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(x) - 64 AS BIGINT)] END)) AS b FROM runs),
sums AS (SELECT w, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, tab),
said AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substring(w, CAST(h % length(w) + 2 AS BIGINT)) ELSE w END AS word, n FROM sums),
voc AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{"".join(chr(c) for c in range(0xC0, 0x100))}', '{_ONE_BYTE}') AS plain
        FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM voc a JOIN voc b ON length(a.word) BETWEEN length(b.word) - 1 AND length(b.word) + 1
         AND a.word <> b.word AND levenshtein(a.plain, b.plain) = 1),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word),
formed AS MATERIALIZED (SELECT word, CASE WHEN m >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN m END AS form_n
           FROM voc LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON chain.root = formed.word WHERE formed.form IS NOT NULL)
SELECT formed.*, root FROM formed JOIN (SELECT chain.word, chain.root FROM chain JOIN formed ON chain.root = formed.word WHERE formed.form IS NULL) USING (word)
"""


@query("op13_spelling_variants", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run in about 199 loses a character, by a checksum of its document and itself; variants are sought among the results."""
    found = spelling.runs(load(spark, sf_dir, "documents").select("doc_id", "text"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = "CAST(h % length(run) AS INT)"
    word = F.expr(f"CASE WHEN h % 199 = 0 THEN concat(substring(run, 1, {at}), substring(run, {at} + 2)) ELSE run END")
    return spelling.variants(spelling.vocabulary(found.withColumn("h", h), word))


OP12_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all({_PLAIN.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT d, doc_id, term, count(*) AS tf FROM t GROUP BY d, doc_id, term),
n AS (SELECT d, sum(tf) AS n FROM tf GROUP BY d),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
m AS (SELECT d, 10 + (90 * CAST(n AS BIGINT) * docs) // words AS m FROM n, s),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_PLAIN.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (d) GROUP BY item_id, d, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY rank <= 10
"""


@query("op12_lexical_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, load(spark, sf_dir, "benchmark").select("item_id", "text"))


OP11_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_PLAIN.format('text')}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s + 1, s + 5), ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS s FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
        JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)
"""


@query("op11_minhash_near_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))
