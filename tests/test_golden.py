"""Small inputs with known results."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weirflow.functions import scalars as fn
from weirflow.operators import aggregate, enrich, eventtime, merge, reshape, rowkey, state, views, windows
from weirflow.session import scratch_path
from weirflow.sources import files


def people(spark, second_loc="北京"):
    rows = [(1, "zs", 18, 10, "北京", 0), (2, "ls", 19, 11, "上海", 1), (3, "ww", 20, 12, "北京", 2),
            (1, "zs1", 10, 30, second_loc, 3), (2, "ls1", 25, 8, "上海", 4)]
    return spark.createDataFrame(rows, "id int, name string, age int, workdays int, loc string, _seq int")


PEOPLE = ["id", "name", "age", "workdays"]


def test_replacing(spark, rows_of):
    p = people(spark)
    assert rows_of(merge.replacing_latest(p, ["loc"], ["id"], "_seq"), *PEOPLE) == [(1, "zs1", 10, 30), (2, "ls1", 25, 8), (3, "ww", 20, 12)]
    assert merge.replacing_composite_key(p, ["loc"], ["id", "name"], "workdays", "_seq").count() == 5
    other = merge.replacing_by_version(people(spark, "上海"), ["loc"], ["id"], "workdays", "_seq")
    assert rows_of(other, *PEOPLE, "loc") == [(1, "zs", 18, 10, "北京"), (1, "zs1", 10, 30, "上海"), (2, "ls", 19, 11, "上海"), (3, "ww", 20, 12, "北京")]


def test_summing(spark, rows_of):
    p = people(spark)
    every = [(1, "zs", 28, 40), (2, "ls", 44, 19), (3, "ww", 20, 12)]
    assert rows_of(merge.summing_all_numeric(p, ["loc"], ["id"], "_seq"), *PEOPLE) == every
    assert rows_of(merge.summing_columns(p, ["loc"], ["id"], "_seq", ["age", "workdays"]), *PEOPLE) == every
    assert rows_of(merge.summing_columns(p, ["loc"], ["id"], "_seq", ["workdays"]), *PEOPLE) == [(1, "zs", 18, 40), (2, "ls", 19, 19), (3, "ww", 20, 12)]


def collapse(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id int, name string, loc string, sss int, _seq int")
    once = merge.collapsing(df, ["loc"], ["id"], "sss", "_seq")
    twice = merge.collapsing(once, ["loc"], ["id"], "sss", "_seq")
    got = sorted(r["name"] for r in once.collect())
    assert got == sorted(r["name"] for r in twice.collect())
    return got


def test_collapsing(spark):
    assert collapse(spark, [(1, "a", "bj", 1), (1, "b", "bj", -1)]) == []
    assert collapse(spark, [(5, "tt", "sh", -1), (5, "tt1", "sh", -1), (5, "tt2", "sh", 1)]) == ["tt"]
    assert collapse(spark, [(5, "tt", "sh", -1), (5, "mm2", "sh", 1)]) == ["mm2", "tt"]
    assert collapse(spark, [(6, "aaa", "bj", 1), (6, "bbb", "sh", -1)]) == ["aaa", "bbb"]
    assert collapse(spark, [(7, "s1", "sh", -1), (7, "s2", "sh", 1)]) == ["s1", "s2"]


def test_versioned_collapsing(spark, rows_of):
    rows = [(1, "zs", 1, 10), (2, "ls", 1, 11), (3, "ww", 1, 12), (1, "zs1", -1, 10), (8, "g1", -1, 50), (8, "g2", -1, 50),
            (8, "g3", 1, 50), (18, "v1", 1, 51), (18, "v2", -1, 3)]
    df = spark.createDataFrame([(*r, "x", i) for i, r in enumerate(rows)], "id int, name string, sss int, ver int, loc string, _seq int")
    once = merge.versioned_collapsing(df, ["loc"], ["id"], "sss", "ver", "_seq")
    assert rows_of(once, "id", "name") == [(18, "v1"), (18, "v2"), (2, "ls"), (3, "ww"), (8, "g1")]
    assert rows_of(merge.versioned_collapsing(once, ["loc"], ["id"], "sss", "ver", "_seq"), "id", "name") == rows_of(once, "id", "name")


@pytest.mark.parametrize("rule", [
    lambda d: merge.replacing_latest(d, ["loc"], ["id"], "_seq"),
    lambda d: merge.summing_all_numeric(d, ["loc"], ["id"], "_seq"),
    lambda d: merge.replacing_by_version(d, ["loc"], ["id"], "workdays", "_seq"),
])
def test_merges_are_idempotent_and_ignore_the_split(spark, rows_of, rule):
    p = people(spark)
    assert rows_of(rule(rule(p))) == rows_of(rule(p)) == rows_of(rule(p.repartition(5)))


def test_salary_states(spark, rows_of):
    rows = [(0, 1, 100), (0, 2, 200), (0, 3, 300), (1, 1, 400), (1, 2, 500), (2, 10, 100), (2, 10, 200), (2, 10, 300)]
    df = spark.createDataFrame(rows, "b int, id int, salary int").withColumn("salary", F.col("salary").cast("decimal(9,2)"))
    out = views.incremental_merged(df, "b", ["id"], {"total": ("sum", "salary")})
    assert [(i, int(t)) for i, t in rows_of(out, "id", "total")] == [(1, 500), (10, 600), (2, 700), (3, 300)]


def test_incremental_view_keeps_batches_apart(spark, rows_of):
    view = views.IncrementalView(spark, scratch_path(spark, "view"), ["id"], {"total": ("sum", "age")})
    batch = lambda *rows: spark.createDataFrame(list(rows), "id int, age int")
    view.populate(batch((1, 18), (2, 19)))
    view.insert(batch((1, 100), (2, 100)), 0)
    view.insert(batch((1, 100), (1, 200)), 1)
    view.insert(batch((1, 100), (1, 200)), 1)  # replayed
    want = [(1, 100), (1, 18), (1, 300), (2, 100), (2, 19)]
    assert rows_of(views.view_rows_without_batch(view)) == want
    assert rows_of(view.merged()) == [(1, 418), (2, 119)] == rows_of(view.compact(scratch_path(spark, "c")).merged())


def test_approximate_distinct_state(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") % 500).alias("v"), (F.col("id") % 7).alias("b"))
    aggs = {"d": ("distinct", "v")}
    merged = aggregate.agg_state_merge(aggregate.agg_state_partial(df, ["k", "b"], aggs), ["k"], aggs)
    assert all(abs(r["d"] - 500) < 25 for r in merged.collect())


def timed(spark, lines):
    rows = [(i, int(line.split(" ")[0]), w) for i, line in enumerate(lines) for w in line.split(" ")[1:]]
    df = spark.createDataFrame(rows, "line bigint, ms bigint, word string")
    return df.withColumns({"ts": F.timestamp_millis("ms"), "seq": F.col("line") * 100 + F.monotonically_increasing_id() % 100})


# each line is one arrival: all its words share the line number as order
@pytest.mark.parametrize("lines, delay, want", [
    (["10000 hello 1", "11000 hello haha", "12000 hello xixi"], 0, {"hello": 2, "1": 1, "haha": 1}),
    (["10000 hello", "11000 tea", "11000 hello", "12000 hello", "15000 hello"], 3, {"hello": 2, "tea": 1}),
    (["10000 hello tea", "11000 hello soul", "12000 hello soul", "10000 hello tea", "15000 hello soul"], 3, {"hello": 3, "tea": 2, "soul": 1}),
])
def test_event_time_windows(spark, lines, delay, want):
    trace = eventtime.assign_window(eventtime.bounded_watermark(timed(spark, lines), "ts", ["line"], delay), "ts", "3 seconds")
    got = eventtime.fired_window_counts(trace, ["word"]).where("unix_millis(window_start) = 9000")
    assert {r["word"]: r["cnt"] for r in got.collect()} == want


def test_punctuated_watermark(spark):
    lines = ["10000 001", "11000 001", "12000 002", "10000 002", "16000 003", "16000 001"]
    trace = eventtime.punctuated_watermark(timed(spark, lines), "ts", ["line"], F.col("word") == "001", 3)
    got = eventtime.fired_window_counts(eventtime.assign_window(trace, "ts", "3 seconds"), ["word"])
    assert {(r["word"], r["cnt"]) for r in got.collect()} == {("001", 2), ("002", 1)}


def test_allowed_lateness(spark):
    lines = ["10000 hello tea", "11000 hello soul", "12000 hello soul", "10000 hello tea", "15000 hello soul", "11500 hello", "18000 x", "11600 hello"]
    trace = eventtime.assign_window(eventtime.bounded_watermark(timed(spark, lines), "ts", ["line"], 3), "ts", "3 seconds")
    out = eventtime.allowed_lateness_refire(trace, ["word"], ["line"], 3).where("word = 'hello' AND unix_millis(window_start) = 9000")
    assert sorted((r["cnt"], r["cls"]) for r in out.collect()) == [(3, "on_time"), (4, "refire")]
    late = eventtime.late_side_output(trace, 3)
    assert [(r["word"], r["ms"]) for r in late.collect()] == [("hello", 11600)]


def test_speed_jump(spark):
    df = spark.createDataFrame([("car1", 100, 0), ("car1", 150, 1), ("car2", 100, 2), ("car2", 120, 3)], "car string, speed int, seq bigint")
    out = state.speed_jump_alert(df, "car", "speed", ["seq"]).orderBy("seq")
    assert [r["message"] for r in out.collect()] == ["car1", "car1 over speed: 150", "car2", "car2"]


def test_running_sum(spark, rows_of):
    rows = [("luffy", 500, 0), ("luffy", 1000, 1), ("luffy", 600, 2), ("nier", 100, 3), ("nier", 200, 4), ("nier", 300, 5)]
    df = spark.createDataFrame(rows, "user string, amount bigint, seq bigint")
    out = state.running_sum_state(df, ["user"], "amount", ["seq"]).orderBy("seq")
    assert [r["total"] for r in out.collect()] == [500, 1500, 2100, 100, 300, 600]


def test_trajectory(spark, rows_of):
    df = spark.createDataFrame([("m1", "a", 0), ("m2", "a", 1), ("m3", "a", 2), ("m1", "b", 3)], "monitor string, car string, seq bigint")
    steps = state.trajectory_steps(df, "car", ["seq"], ["monitor"])
    asked = spark.createDataFrame([("a", 2)], "car string, at_pos bigint")
    assert rows_of(state.trajectory_at(steps, "car", asked), "pos", "monitor") == [(1, "m1"), (2, "m2")]


def test_overspeed_timer(spark, rows_of):
    df = spark.createDataFrame([("bmw", 200, 10_000), ("cc", 100, 10_000), ("bmw", 180, 10_000)], "car string, speed int, ms bigint")
    out = state.overspeed_timer_alert(df.withColumn("ts", F.timestamp_millis("ms")), "car", "speed", "ts")
    assert rows_of(out.select("car", F.unix_millis("fire_ts"))) == [("bmw", 12_000)]


def test_trade_totals(spark, rows_of):
    rows = [(f"KEY{i % 3}", i, 56803793, 1, 899) for i in range(9)]
    df = spark.createDataFrame(rows, "key string, seq int, user bigint, qty bigint, cent bigint")
    assert rows_of(state.trade_totals(df, "key", ["seq"], "user", "qty", "cent")) == [(56803793, 3, 2697)]


def brute_first_seen(rows, ttl):
    out, last = [], {}
    for k, at, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in last or at - last[k] >= ttl:
            last[k] = at
            out.append(seq)
    return sorted(out)


@pytest.mark.parametrize("group_rows", [5, 1000])
def test_first_seen_with_expiry(spark, group_rows):
    """Hot keys by doubled pointers, and all keys small."""
    import random


    rng = random.Random(3)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.randrange(0, 500), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, s bigint, seq bigint").withColumn("ts", F.timestamp_seconds("s"))
    out = state.dedup_first_seen_ttl(df, ["k"], "ts", ["seq"], 60, group_rows)
    assert sorted(r["seq"] for r in out.collect()) == brute_first_seen(rows, 60)
    assert out.columns == df.columns


def test_lookup(spark):
    path = scratch_path(spark, "cities")
    cities = [("001", "北京"), ("002", "上海"), ("009", "苏州")]
    spark.createDataFrame([(f"{i} {c}",) for i, c in cities], "value string").write.text(path)
    facts = spark.createDataFrame([("001",), ("002",), ("009",), ("099",)], "id string").withColumn("n", F.col("id").cast("int"))
    out = enrich.lookup_static(facts, enrich.read_dimension(spark, path), "n", "id", "label").orderBy("n")
    assert [r["label"] for r in out.collect()] == ["北京", "上海", "苏州", "not found"]


def test_config_lookup_answers_as_of(spark, rows_of):
    events = spark.createDataFrame([(1, "a"), (3, "a"), (5, "a"), (6, "b")], "seq bigint, id string")
    config = spark.createDataFrame([("a", 2, "x"), ("a", 4, "y")], "cid string, cseq bigint, city string")
    out = enrich.lookup_config_stream(events, config, "id", "seq", "cid", "cseq", "city")
    assert rows_of(out, "seq", "label") == [(1, "not found city"), (3, "x"), (5, "y"), (6, "not found city")]


def test_scores_three_forms(spark, rows_of):
    path = scratch_path(spark, "scores")
    spark.createDataFrame([("001,zhangsan,99",), ("002,lisi,88.5",), ("003,wangwu,66.66",)], "value string").write.text(path)
    df = files.read_csv_typed(spark, path, "id string, name string, score double", view="wf_scores")
    want = [("lisi", 88.5), ("zhangsan", 99.0)]
    assert rows_of(reshape.select_where(df, ["name", "score"], "score > 70")) == want
    assert rows_of(reshape.select_where_sql(spark, "wf_scores", ["name", "score"], "score > 70")) == want


def test_iterate(spark, rows_of):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, -7)], "id int, v int")
    out = reshape.iterate_until(df, {"v": "CASE WHEN v > 0 THEN v - 3 ELSE v END"}, "v > 0", unroll=1)
    assert rows_of(out, "id", "v") == [(1, -2), (2, -1), (3, 0), (4, -2), (5, -7)]
    df.createOrReplaceTempView("wf_numbers")
    assert rows_of(reshape.iterate_until_sql(spark, "wf_numbers", "v")) == [(-7, -7), (1, -2), (2, -1), (3, 0), (4, -2)]


def test_tokens_like_a_java_split(spark):
    rows = [("a  b",), ("a b  ",), ("",), ("  ",), (" a",)]
    out = spark.createDataFrame(rows, "t string").select(reshape.tokens("t").alias("w")).collect()
    assert [r["w"] for r in out] == [["a", "", "b"], ["a", "b"], [""], [], ["", "a"]]


def test_side_output_forms_agree(spark):
    tagged = reshape.side_output_split(files.generate_sequence(spark, 1, 10), {"odd": F.col("value") % 2 != 0}, "even")
    assert [r[0] for r in reshape.split_select(tagged, "even").orderBy("value").collect()] == [2, 4, 6, 8, 10]
    assert reshape.split_select(tagged, "even", "odd").count() == 10


def test_bitmap(spark, rows_of):
    base = spark.createDataFrame([(1,), (2,), (3,), (1000,)], "v bigint")
    values = aggregate.bitmap_add_range(base, "v", 10_000, 12_000)
    bitmap = aggregate.bitmap_build(values, "v")
    assert aggregate.bitmap_cardinality(bitmap).first()[0] == 2004
    union = aggregate.bitmap_or(aggregate.bitmap_build(base, "v"), aggregate.bitmap_build(spark.range(10_000, 12_000).toDF("v"), "v"))
    assert rows_of(union) == rows_of(bitmap)
    probe = spark.createDataFrame([(1000,), (7,), (2**40,)], "v bigint")
    assert rows_of(aggregate.bitmap_contains(bitmap, probe, "v")) == [(1000, True), (1099511627776, False), (7, False)]
    ranked = {r["v"]: r["rank"] for r in aggregate.bitmap_rank_select(bitmap, "v").collect()}
    assert ranked[2] == 2 and [v for v, r in ranked.items() if r == 3 + 1] == [1000]


def test_bitmap_rank_and_select(spark, split_rows):
    """Edges of bytes and buckets, zero, and places outside of every bucket; also with the buckets scanned in blocks."""
    elements = sorted({0, 1, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, 10**6, *range(40_000, 40_100, 3)})
    bitmap = aggregate.bitmap_build(spark.createDataFrame([(x,) for x in elements], "v bigint"), "v")
    probes = [0, 1, 2, 7, 8, 9, 32766, 32767, 32768, 32769, 39_999, 40_050, 65536, 65537, 70_000, 10**6, 10**9, None]
    table = spark.createDataFrame([(x,) for x in probes], "p bigint")
    numbers = spark.createDataFrame([(i,) for i in [*range(len(elements)), len(elements), 10**9, None]], "i bigint")
    for limit in (1_000_000, 3):
        split_rows(limit)
        rank = {r.p: r["rank"] for r in aggregate.bitmap_rank(bitmap, table, "p").collect()}
        assert rank == {p: None if p is None else sum(e <= p for e in elements) for p in probes}
        found = {r.i: r.selected for r in aggregate.bitmap_select(bitmap, numbers, "i").collect()}
        assert found == {i: e for i, e in enumerate(elements)} | {len(elements): None, 10**9: None, None: None}
    assert {r.p: r["rank"] for r in aggregate.bitmap_rank(bitmap.limit(0), table, "p").collect()} == {p: None if p is None else 0 for p in probes}


@pytest.mark.parametrize("text", ["1.2.3", "300.1.1.1", "1.2.3.4.5", "", "a.b.c.d", "1..2.3", "-1.2.3.4", "256.0.0.0"])
def test_wrong_ipv4(spark, text):
    with pytest.raises(Exception, match="not an IPv4 address"):
        spark.createDataFrame([(text,)], "t string").select(fn.ipv4_to_number("t")).collect()


@pytest.mark.parametrize("text", ["1:2", "1:2:3:4:5:6:7:8:9", "1::2::3", "12345::", "g::", "1:2:3:4:5:6:7:8::", "", ":"])
def test_wrong_ipv6(spark, text):
    with pytest.raises(Exception, match="not an IPv6 address"):
        spark.createDataFrame([(text,)], "t string").select(fn.ipv6_to_hex("t")).collect()


def test_addresses(spark):
    import ipaddress

    sixes = ["::", "::1", "2001:DB8::8a2e:370:7334", "1:2:3:4:5:6:7:8", "fe80::", "1:2:3:4:5:6:7::"]
    rows = spark.createDataFrame([(t,) for t in [*sixes, None]], "t string").select("t", fn.ipv6_to_hex("t").alias("h")).collect()
    assert {r.t: r.h for r in rows} == {t: f"{int(ipaddress.IPv6Address(t)):032x}" for t in sixes} | {None: None}
    assert spark.createDataFrame([(None,)], "t string").select(fn.ipv4_to_number("t").alias("n")).first().n is None


def test_keyed_fold(spark, rows_of):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("a", 9), ("a", 1)], "k string, v bigint").repartition(4)
    assert rows_of(aggregate.keyed_fold(df, ["k"], "v", max, "bigint")) == [("a", 9), ("b", 5)]


def test_count_window_first_word(spark, rows_of):
    df = spark.createDataFrame([(i, w) for i, w in enumerate("abcdefg")], "seq bigint, w string")
    out = windows.count_window(df, ["seq"], 3, {"w": F.min_by("w", "seq"), "n": F.count(F.lit(1))})
    assert rows_of(out) == [(0, "a", 3), (1, "d", 3)]


def test_types(spark):
    one = spark.range(1)
    row = one.select(
        fn.to_decimal64(F.lit(2.3656), 3).alias("x"), fn.to_decimal32(F.lit(2.3656), 2).alias("y"),
        fn.type_name(fn.to_decimal64(F.lit(2.3656), 3) + fn.to_decimal32(F.lit(2.3656), 2)).alias("z"),
        F.octet_length(fn.fixed_string(F.lit("hello"), 6)).alias("len"), fn.fixed_string_equals(fn.fixed_string(F.lit("a"), 2), "a\0", 2).alias("eq"),
        fn.ipv4_to_number(F.lit("116.253.40.133")).alias("ip"), fn.number_to_ipv4(F.lit(1962748037)).alias("back"),
        fn.ipv6_to_hex(F.lit("2001:db8::1")).alias("ip6"), fn.array_at(fn.array_of(F.lit("x"), F.lit("y")), 1).alias("first"),
        fn.nested(id=F.array(F.lit(1), F.lit(2)), name=F.array(F.lit("a"), F.lit("b"))).alias("nested"),
    ).first()
    assert str(row["x"]) == "2.366" and str(row["y"]) == "2.37" and row["z"] == "decimal(19,3)"
    assert row["len"] == 6 and row["eq"] and row["ip"] == 1962748037 and row["back"] == "116.253.40.133"
    assert row["ip6"] == "20010db8000000000000000000000001" and row["first"] == "x"
    assert [tuple(n) for n in row["nested"]] == [(1, "a"), (2, "b")]
    enum = fn.EnumType({"男": 1, "女": 0})
    got = one.select(enum.code(F.lit("男")).alias("c"), enum.label(F.lit(0)).alias("l")).first()
    assert tuple(got) == (1, "女")


@pytest.mark.parametrize("bad", [
    lambda: fn.fixed_string(F.lit("toolong"), 3),
    lambda: fn.EnumType({"a": 1}).code(F.lit("b")),
    lambda: fn.EnumType({"a": 1}).label(F.lit(7)),
    lambda: fn.nested(a=F.array(F.lit(1)), b=F.array(F.lit(1), F.lit(2))),
])
def test_bad_values_are_errors(spark, bad):
    with pytest.raises(PySparkException):
        spark.range(1).select(bad().alias("x")).collect()


def test_match_variant(spark):
    texts = ['88', 'false', '66', '12', '"hi"', '1.5', 'true']
    out = spark.createDataFrame([(t,) for t in texts], "t string").select(fn.match_variant(F.parse_json("t")).alias("m"))
    unknown = "I don't know what type it is"
    assert [r["m"] for r in out.collect()] == ["88 ...is 88", "false...is false", "66...is int, > 50", "12...12...is int", unknown, unknown, unknown]


def test_packed_record_is_smaller(spark):
    """Four text fields per call: one packed column takes less room than four cells."""
    df = spark.range(5000).select(
        F.concat(F.lit("181-"), F.col("id").cast("string")).alias("rowkey"), F.concat(F.lit("177"), F.lpad((F.col("id") * 7919 % 10**8).cast("string"), 8, "0")).alias("opponent"),
        (F.col("id") % 100).cast("string").alias("seconds"), F.concat(F.lit("2021"), F.lpad((F.col("id") % 10**10).cast("string"), 10, "0")).alias("date"), (F.col("id") % 2).cast("string").alias("type"))
    columns = ["opponent", "seconds", "date", "type"]
    size = lambda d: d.agg(F.sum(sum((F.octet_length(c) for c in d.columns), F.lit(0)))).first()[0]
    cells = rowkey.to_cells(df, "rowkey", F.lit(0).cast("long"), columns).drop("ts")
    packed = rowkey.pack_record(df, ["rowkey"], columns)
    assert size(packed) < 0.5 * size(cells)
    assert sorted(map(tuple, rowkey.unpack_record(packed, columns).collect())) == sorted(map(tuple, df.select("rowkey", *columns).collect()))


def test_prefix_as_range(spark):
    assert rowkey.prefix_stop("ab") == "ac"
    df = spark.createDataFrame([("ab",), ("abz",), ("ac",), ("aa",)], "rowkey string")
    assert sorted(r[0] for r in df.where(rowkey.prefix_predicate("ab")).collect()) == ["ab", "abz"]


@pytest.mark.parametrize("size, slide", [(6, 4), (3, 5), (8, 2), (4, 4)])
def test_sliding_count_windows(spark, rows_of, size, slide):
    values = [(i * 7) % 11 for i in range(30)]
    df = spark.createDataFrame(list(enumerate(values)), "seq bigint, v bigint")
    want = sorted((m, sum(values[max(0, m * slide - size):m * slide])) for m in range(1, len(values) // slide + 1))
    by_row = windows.count_window(df, ["seq"], size, {"s": F.sum("v")}, slide=slide)
    by_pane = windows.count_window_by_panes(df, ["seq"], size, slide, {"p": F.sum("v")}, {"s": F.sum("p")})
    assert sorted(map(tuple, by_pane.select("block", "s").collect())) == want
    if size != slide:
        assert sorted(map(tuple, by_row.select("block", "s").collect())) == want
