"""Side effects: files, partitions, statistics pruning, statements sent to a database."""

from conftest import SF_DIR
from pyspark.sql import functions as F

from weirflow.operators import distribution, maintenance, reshape
from weirflow.plans.maintenance import _table
from weirflow.session import load, scratch_path
from weirflow.sinks import files as sinks
from weirflow.sinks.jdbc import merge_statement
from weirflow.sinks.messages import message_envelope


def by_loc(spark):
    return spark.createDataFrame([(1, "zs", "北京"), (2, "ls", "sh"), (3, "ww", "北京"), (4, "ml", "sh")], "id int, name string, loc string")


def parts(spark, name):
    return {(r["partition"], r["name"]) for r in maintenance.list_parts(spark, name, "loc").collect()}


def test_only_the_touched_partition_is_rewritten(spark, rows_of):
    name = _table(spark, by_loc(spark), "loc", ["id"])
    before = parts(spark, name)
    maintenance.mutate_update(spark, name, "loc", ["id"], {"name": F.lit("www")}, F.col("name") == "ww")
    after = parts(spark, name)
    assert {p for p in before if p[0] == "sh"} == {p for p in after if p[0] == "sh"}
    assert {p for p in before if p[0] == "北京"}.isdisjoint(after)
    assert rows_of(spark.table(name), "id", "name") == [(1, "zs"), (2, "ls"), (3, "www"), (4, "ml")]
    maintenance.mutate_delete(spark, name, "loc", ["id"], F.col("name").isin("ls", "ml"))
    assert rows_of(spark.table(name), "id") == [(1,), (3,)]
    assert {p[0] for p in parts(spark, name)} == {"北京"}


def test_inserts_add_parts_and_compaction_merges_them(spark, rows_of):
    name = _table(spark, by_loc(spark), "loc", ["id"])
    extra = spark.createDataFrame([(5, "xx", "sh")], "id int, name string, loc string")
    maintenance.insert(extra, name)
    assert sum(p[0] == "sh" for p in parts(spark, name)) > 1
    maintenance.compact(spark, name, "loc", ["id"], "sh", lambda d: d.where("id <> 2"))
    assert rows_of(spark.table(name).where("loc = 'sh'"), "id") == [(4,), (5,)]
    maintenance.compact(spark, name, "loc", ["id"], "sh", lambda d: d.where("false"))
    assert rows_of(spark.table(name), "id") == [(1,), (3,)]


def test_detach_and_attach(spark, rows_of):
    name = _table(spark, by_loc(spark), "loc", ["id"])
    maintenance.detach_partition(spark, name, "loc", "北京")
    assert rows_of(spark.table(name), "id") == [(2,), (4,)]
    maintenance.attach_partition(spark, name, "loc", "北京")
    assert rows_of(spark.table(name), "id") == [(1,), (2,), (3,), (4,)]


def files_read(df):
    """Files a scan opened, from the metrics of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    metric = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    return sum(m.get().value() for m in metric if m.isDefined())


def scan_rows(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metric = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sum(m.get().value() for m in metric if m.isDefined())


def test_key_range_skips_files_by_statistics(spark):
    path = scratch_path(spark, "sorted")
    orders = load(spark, SF_DIR, "orders").select("o_orderkey", "o_custkey")
    maintenance.write_sorted(orders, path, "o_orderkey", 8)
    total = orders.count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = maintenance.key_range_read(spark, path, "o_orderkey", 100, 150)
        assert scan_rows(found) <= total / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_partition_filter_prunes_folders(spark):
    name = _table(spark, by_loc(spark), "loc", ["id"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        every = files_read(spark.table(name))
        assert files_read(spark.table(name).where("loc = 'sh'")) < every
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_write_text_file_count(spark):
    path = scratch_path(spark, "text")
    sinks.write_text(spark.range(100).select(F.col("id").cast("string")), path, 3)
    assert spark.read.text(path).select(F.input_file_name()).distinct().count() == 3


def test_rescale_without_shuffle(spark):
    df = distribution.dist_rebalance(spark.range(100).toDF("v"), 4)
    down = distribution.dist_rescale(df, 2)
    assert down._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 2
    up = distribution.rows_per_partition(distribution.dist_rescale(down, 4))
    assert up.count() == 4


def test_custom_partition_for_negative_keys(spark):
    df = spark.createDataFrame([(-3,), (5,), (2,)], "k int")
    got = {r["k"]: r["part"] for r in distribution.with_partition(distribution.dist_custom(df, 4, "k")).collect()}
    assert got == {-3: 1, 5: 1, 2: 2}


def test_sharded_write(spark):
    path = scratch_path(spark, "shards")
    distribution.write_sharded(spark.range(100).toDF("id"), path, "id", 3)
    back = spark.read.parquet(path)
    assert back.count() == 100 and back.groupBy("id").agg(F.countDistinct("shard").alias("n")).where("n <> 1").isEmpty()


def test_merge_statement():
    cols, keys = ["word", "word_count"], ["word"]
    assert merge_statement("wc", "wc_stage", cols, keys) == (
        "MERGE INTO wc t USING wc_stage s ON t.word = s.word WHEN MATCHED THEN UPDATE SET t.word_count = s.word_count "
        "WHEN NOT MATCHED THEN INSERT (word, word_count) VALUES (s.word, s.word_count)")
    only = merge_statement("info", "st", ["id", "name", "age"], ["id"], update=["name"])
    assert "SET t.name = s.name WHEN" in only
    assert "MATCHED THEN UPDATE" not in merge_statement("info", "st", ["id"], ["id"])


def test_message_routing_falls_back(spark):
    df = spark.createDataFrame([("a", "t1"), ("b", None)], "v string, topic_field string")
    out = message_envelope(df, None, "v", "dflt", "topic_field", "tag0", "missing").collect()
    assert [(r["topic"], r["tag"], r["key"], bytes(r["value"])) for r in out] == [("t1", "tag0", None, b"a"), ("dflt", "tag0", None, b"b")]


def test_task_resource_is_closed_on_failure(spark):
    mark = scratch_path(spark, "closed")
    spark.range(1).write.parquet(mark)

    def broken(resource, batch):
        raise ValueError("bad batch")

    df = reshape.map_with_lifecycle(spark.range(3).repartition(1), "id bigint", dict, broken, lambda r: open(f"{mark}/closed.txt", "w").close())
    try:
        df.collect()
        raise AssertionError("should have failed")
    except Exception as e:
        assert "bad batch" in str(e)
    assert spark.read.text(f"{mark}/closed.txt").count() == 0


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["word", "cnt"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
