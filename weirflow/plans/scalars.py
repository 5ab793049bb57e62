"""Scalar functions and types."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions import scalars as fn
from weirflow.plans.registry import events, query
from weirflow.session import load


@query("fn_float32", """
    SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS f32, 1 - value AS rest FROM events""")
def fn_float32(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", fn.to_float32("value").cast("double").alias("f32"), (1 - fn.to_float64("value")).alias("rest"))


@query("fn_decimal", """
    SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,3)) AS VARCHAR) AS x, 'decimal(18,3)' AS xtype,
           CAST(CAST(p_retailprice AS DECIMAL(9,2)) AS VARCHAR) AS y, 'decimal(9,2)' AS ytype,
           CAST(CAST(CAST(p_retailprice AS DECIMAL(18,3)) + CAST(p_retailprice AS DECIMAL(9,2)) AS DECIMAL(19,3)) AS VARCHAR) AS z,
           'decimal(19,3)' AS ztype FROM part""")
def fn_decimal(spark, sf_dir):
    d = load(spark, sf_dir, "part").select("p_partkey", fn.to_decimal64("p_retailprice", 3).alias("x"), fn.to_decimal32("p_retailprice", 2).alias("y"))
    z = F.col("x") + F.col("y")
    s = lambda c: c.cast("string")
    return d.select(
        "p_partkey", s(F.col("x")).alias("x"), fn.type_name("x").alias("xtype"), s(F.col("y")).alias("y"), fn.type_name("y").alias("ytype"),
        s(z).alias("z"), fn.type_name(z).alias("ztype"))


@query("fn_fixed_string", """
    SELECT event_id, CAST(10 AS BIGINT) AS bytes, event_type = 'click' AS is_click, event_type AS back FROM events""")
def fn_fixed_string(spark, sf_dir):
    d = events(spark, sf_dir).withColumn("f", fn.fixed_string("event_type", 10))
    back = F.replace(F.col("f"), F.chr(F.lit(0)), F.lit(""))
    return d.select("event_id", F.octet_length("f").cast("bigint").alias("bytes"), fn.fixed_string_equals("f", "click\0", 10).alias("is_click"), back.alias("back"))


@query("fn_uuid", """
    SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS well_formed FROM events""")
def fn_uuid(spark, sf_dir):
    ids = events(spark, sf_dir, "event_id").select(fn.new_uuid().alias("u"))
    good = F.col("u").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[0-9a-f]{4}-[0-9a-f]{12}$")
    return ids.agg(F.count(F.lit(1)).alias("total"), F.count_if(good).alias("well_formed"))


@query("fn_date", """
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, TRUE AS past FROM events""")
def fn_date(spark, sf_dir):
    now, today = fn.now_and_today()
    d = events(spark, sf_dir, "event_id", "ts").withColumn("text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    date = fn.to_date("text")
    return d.select("event_id", date.cast("string").alias("d"), ((date < today) & (F.to_date(now) == today)).alias("past"))


@query("fn_datetime_tz", """
    SELECT event_id, date_trunc('second', ts) - INTERVAL 8 HOUR AS utc, date_trunc('millisecond', ts) AS ms FROM events""")
def fn_datetime_tz(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    d = events(spark, sf_dir, "event_id", "ts")
    ntz = lambda c: c.cast("timestamp_ntz")
    return d.select("event_id", ntz(fn.date_time_in_zone(text, "Asia/Shanghai")).alias("utc"), ntz(fn.date_time64("ts", 3)).alias("ms"))


TYPES = fn.EnumType({"view": 0, "click": 1, "purchase": 2, "signup": 3, "error": 4})


@query("fn_enum", """
    SELECT event_id, CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS INTEGER) AS code,
           event_type AS label, CASE WHEN value > 10 THEN 1 ELSE 0 END AS big FROM events""")
def fn_enum(spark, sf_dir):
    d = events(spark, sf_dir)
    code = TYPES.code("event_type")
    big = fn.BOOLEAN_ENUM.code((F.col("value") > 10).cast("string"))
    return d.select("event_id", code.cast("int").alias("code"), TYPES.label(code).alias("label"), big.cast("int").alias("big"))


@query("fn_nullable", """
    SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN user_id END AS maybe,
           coalesce(CASE WHEN user_id % 7 <> 0 THEN user_id END, 0) AS never FROM events""")
def fn_nullable(spark, sf_dir):
    maybe = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    return events(spark, sf_dir).select("event_id", maybe.alias("maybe"), fn.or_default(maybe, 0).alias("never"))


@query("fn_array", """
    SELECT doc_id, string_split(text, ' ')[1] AS first, string_split(text, ' ')[3] AS third, lang AS made FROM documents""")
def fn_array(spark, sf_dir):
    words = F.split("text", " ")
    return load(spark, sf_dir, "documents").select(
        "doc_id", fn.array_at(words, 1).alias("first"), fn.array_at(words, 3).alias("third"), fn.array_at(fn.array_of("source", "lang"), 2).alias("made"))


@query("fn_tuple", "SELECT event_id, event_type AS a, user_id AS b FROM events")
def fn_tuple(spark, sf_dir):
    d = events(spark, sf_dir).select("event_id", fn.tuple_of("event_type", "user_id").alias("t"))
    return d.select("event_id", F.col("t._1").alias("a"), F.col("t._2").alias("b"))


@query("fn_nested", """
    SELECT n_nationkey AS event_key, c_custkey AS dept_id, c_name AS dept_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def fn_nested(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    # one struct per row: arrays stay as short as the input row
    d = c.select(F.col("c_nationkey").alias("event_key"), fn.nested(dept_id=F.array("c_custkey"), dept_name=F.array("c_name")).alias("dept_info"))
    return d.select("event_key", F.inline("dept_info"))


@query("fn_ipv6", """
    SELECT event_id, '20010db8' || lpad(lower(to_hex(user_id % 65536)), 4, '0') || repeat('0', 12) || lpad(lower(to_hex(event_id)), 8, '0') AS hex,
           '2001:db8:' || lower(to_hex(user_id % 65536)) || ':0:0:0:' || lower(to_hex(event_id // 65536)) || ':' || lower(to_hex(event_id % 65536)) AS ip FROM events""")
def fn_ipv6(spark, sf_dir):
    """Addresses with zero groups left out to 32 digits, and these to eight groups."""
    part = lambda e: F.lower(F.hex(F.expr(e)))
    text = F.concat(F.lit("2001:DB8:"), part("user_id % 65536"), F.lit("::"), part("event_id div 65536"), F.lit(":"), part("event_id % 65536"))
    digits = fn.ipv6_to_hex(text)
    return events(spark, sf_dir).select("event_id", digits.alias("hex"), fn.hex_to_ipv6(digits).alias("ip"))


@query("fn_ipv4", """
    SELECT event_id, CAST(user_id % 256 AS BIGINT) * 16777216 + (event_id % 256) * 65536 + (event_id % 7) * 256 + 9 AS num,
           CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.' || CAST(event_id % 7 AS VARCHAR) || '.9' AS ip FROM events""")
def fn_ipv4(spark, sf_dir):
    parts = [F.col("user_id") % 256, F.col("event_id") % 256, F.col("event_id") % 7, F.lit(9)]
    text = F.concat_ws(".", *[p.cast("string") for p in parts])
    num = fn.ipv4_to_number(text)
    return events(spark, sf_dir).select("event_id", num.alias("num"), fn.number_to_ipv4(num).alias("ip"))


@query("fn_yyyymm", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS yyyymm, strftime(o_orderdate, '%Y%m%d%H%M') AS minute FROM orders""")
def fn_yyyymm(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", fn.yyyymm("o_orderdate").alias("yyyymm"), fn.minute_key("o_orderdate").alias("minute"))


@query("fn_case_match", """
    WITH x AS (SELECT event_id, user_id, user_id % 101 AS n FROM events)
    SELECT event_id, CASE WHEN user_id % 11 = 0 THEN 'false...is false' WHEN user_id % 13 = 0 THEN 'I don''t know what type it is'
      WHEN n = 88 THEN '88 ...is 88' WHEN n > 50 THEN CAST(n AS VARCHAR) || '...is int, > 50'
      ELSE CAST(n AS VARCHAR) || '...' || CAST(n AS VARCHAR) || '...is int' END AS matched,
      CASE WHEN n = 1 THEN 'one' WHEN n < 10 THEN 'few' END AS partial FROM x""")
def fn_case_match(spark, sf_dir):
    n = F.col("user_id") % 101
    text = F.when(F.col("user_id") % 11 == 0, "false").when(F.col("user_id") % 13 == 0, '"hi"').otherwise(n.cast("string"))
    matched = fn.match_variant(F.parse_json(text))
    partial = fn.case_match([(n == 1, "one"), (n < 10, "few")])
    return events(spark, sf_dir).select("event_id", matched.alias("matched"), partial.alias("partial"))
