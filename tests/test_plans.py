"""Plan properties that the scale design relies on."""

import re

from pyspark.sql import functions as F

from tables import SF_SMALL
from fraudlens.operators import fused
from fraudlens.operators.reports import ECOMMERCE_FRAUD, inputs_of
from fraudlens.plans import queries as Q
from fraudlens.sources.envelope import decode_transactions, read_batch


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fused_report_set_reads_topic_once_with_narrow_decode(spark):
    t = Q.fixture_topics(spark, SF_SMALL)
    env = read_batch(spark, t, Q.TX_TOPIC, Q.BOUNDED_START, Q.BOUNDED_END)
    rec = decode_transactions(env, inputs_of(ECOMMERCE_FRAUD))
    plan = _plan(fused.fused_aggregate(rec, ECOMMERCE_FRAUD))
    assert plan.count("FileScan parquet") == 1
    assert "Expand" in plan and "partial_count" in plan
    assert "user_gender" not in plan and "total_amount" not in plan   # narrow from_json
    assert "PushedFilters: [Or(Not(EqualTo(partition,1)),GreaterThanOrEqual(offset" in plan


def test_line_items_and_orders_meet_in_shuffle_join(spark):
    plan = _plan(Q.QUERIES["fraud_category"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan
    # the fact scan never feeds a broadcast
    for part in plan.split("BroadcastExchange")[1:]:
        head = part.split("\n")[:4]
        assert not any("lineitem" in line for line in head)


def test_upsert_neither_reads_nor_shuffles_anything(spark, scratch, monkeypatch):
    """A put's write holds no scan of the table and no exchange."""
    from fraudlens.sinks import keyed
    path = scratch("plan-table")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int")
    keyed.upsert(spark, df, path, "k", ["v"])
    plans = []
    write = keyed._write_put
    monkeypatch.setattr(keyed, "_write_put", lambda rows, *a: (plans.append(_plan(rows)), write(rows, *a))[1])
    keyed.upsert(spark, df, path, "k", ["v"])
    assert len(plans) == 1 and "FileScan" not in plans[0] and "Exchange" not in plans[0]
    assert "CollectMetrics" in plans[0]                       # rows are counted by the write itself


def test_keyed_lookup_pushes_its_keys_to_the_scan(spark, scratch):
    from fraudlens.sinks.keyed import read_table, upsert
    path = scratch("plan-table")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int")
    upsert(spark, df, path, "k", ["v"])
    upsert(spark, df.where("v < 5").withColumn("v", F.col("v") + 100), path, "k", ["v"])
    found = read_table(spark, path, ["k1", "k40", "none"])
    assert {r.k: r.v for r in found.collect()} == {"k1": 101, "k40": 40}
    assert re.search(r"PushedFilters: \[.*In\(k, \[k1,k40,none\]\)", _plan(found))
    assert "WindowGroupLimit" in _plan(read_table(spark, path))            # a hot key is cut down before the exchange


def test_ingest_counts_in_its_one_pass(spark, scratch, monkeypatch):
    """One scan of the CSV, the count observed in the write, no footer read."""
    from fraudlens.plans import jobs
    from fraudlens.sinks import publish
    from fraudlens.sinks.files import write_csv
    from fraudlens.sources.envelope import files
    path, plans = scratch("csv"), []
    write_csv(spark.range(25).selectExpr("concat('P', id) AS `Project Code`", "id AS `PQ#`"), path)
    write = publish.write_envelopes
    monkeypatch.setattr(publish, "write_envelopes", lambda s, df, *a: (plans.append(_plan(df)), write(s, df, *a))[1])
    assert jobs.ingest_csv(spark, path, files(scratch("t")), "supply") == 25
    assert len(plans) == 1 and plans[0].count("CollectMetrics") and plans[0].count("FileScan csv") == 1


def test_auc_stays_in_the_jvm(spark):
    plan = _plan(Q.QUERIES["auc_fraud_probability"](spark, SF_SMALL))
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_label_share_does_not_pay_for_the_second_pass(spark):
    from fraudlens.operators import dashboard
    frames = dashboard.dashboard_tables(Q.sc(spark, SF_SMALL))
    assert "lineitem" not in _plan(frames["label_share_country"])          # from the checkpointed aggregate
    assert "lineitem" in _plan(frames["freight_by_project"])               # still lazy


def test_model_input_is_staged_narrow(spark):
    from fraudlens.ml.model import train_and_score
    _, pred = train_and_score(Q.sc(spark, SF_SMALL))
    scan = [line for line in _plan(pred.select("pq", "prediction")).split("\n") if "FileScan parquet" in line]
    assert len(scan) == 1 and "item_description" not in "".join(pred.columns)


def test_dimension_broadcast_only_within_bound(spark):
    from fraudlens.plans.joins import join_dimension
    fact = spark.range(0, 5000).selectExpr("id % 300 AS k", "id AS v")
    dim = spark.range(0, 300).selectExpr("id AS k2", "id * 2 AS w")
    small = _plan(join_dimension(fact, dim, F.col("k") == F.col("k2"), max_rows=1000))
    assert "BroadcastHashJoin" in small
    big = _plan(join_dimension(fact, dim, F.col("k") == F.col("k2"), max_rows=100))
    assert "BroadcastExchange" not in big and "SortMergeJoin" in big
    wide = dim.withColumn("text", F.repeat(F.lit("x"), 1000))
    heavy = _plan(join_dimension(fact, wide, F.col("k") == F.col("k2"), max_rows=1000, max_bytes=10_000))
    assert "BroadcastExchange" not in heavy


def test_broadcast_memo_follows_the_files(spark, scratch):
    from fraudlens.plans.joins import is_bounded
    path = scratch("dim")
    spark.range(10).write.parquet(path)
    assert is_bounded(spark.read.parquet(path), 100)
    spark.range(1000).write.mode("overwrite").parquet(path)
    assert not is_bounded(spark.read.parquet(path), 100)


def test_hot_key_is_preaggregated_and_exact(spark, scratch):
    """One key holds 40 % of the rows: results stay exact and every
    aggregate has a partial phase before its shuffle."""
    from fraudlens.operators.reports import report
    from fraudlens.sinks.keyed import read_table, upsert
    n = 20000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 5 < 2 THEN 'HOT' ELSE concat('k', id % 97) END AS category",
        "CAST(id % 4 = 0 AS INT) AS fraud_label",
        "concat('t', id) AS transaction_id", "id AS v")
    rep = {r.category: r for r in report("fraud_category", df).collect()}
    hot = [i for i in range(n) if i % 5 < 2]
    assert rep["HOT"].total_transactions == len(hot)
    assert rep["HOT"].fraud_count == sum(1 for i in hot if i % 4 == 0)
    assert "partial_count" in _plan(report("fraud_category", df))
    path = scratch("hot-table")
    res = upsert(spark, df.select(F.col("category").alias("k"), "v"), path, "k", ["v"])
    assert res.rows_in == n
    got = {r.k: r.v for r in read_table(spark, path).collect()}
    assert got["HOT"] == max(i for i in range(n) if i % 5 < 2)


def test_only_the_topic_that_is_read_is_written_and_unsorted(spark, monkeypatch):
    """A write partitioned by the topic sorts whole messages, and commits in the root folder."""
    from fraudlens.folder import Folder
    monkeypatch.setattr(Q, "_TOPICS", {})
    t = Q.fixture_topics(spark, SF_SMALL, Q.TX_TOPIC)
    assert Folder(spark, t.root).names() == [f"topic={Q.TX_TOPIC}"]
    assert "_SUCCESS" in Folder(spark, t.topic_path(Q.TX_TOPIC)).names()
    lines = Q.tx(spark, SF_SMALL).count()
    assert read_batch(spark, t, Q.TX_TOPIC).count() == lines
    assert Q.fixture_topics(spark, SF_SMALL).root == t.root                # the other topic joins it
    assert read_batch(spark, t, Q.SC_TOPIC).count() == read_batch(spark, t, Q.TX_TOPIC).count() == lines


def test_one_topic_is_published_without_a_sort(spark, scratch):
    from fraudlens.folder import Folder
    from fraudlens.sinks.publish import publish, publish_many
    from fraudlens.sources.envelope import files
    t, df = files(scratch("t")), spark.range(10)
    assert publish(spark, df, t, "one") == 10 and publish(spark, df, t, "one") == 10
    assert Folder(spark, t.root).names() == ["topic=one"]
    assert publish_many(spark, {"one": df, "two": df}, t) == 20
    assert read_batch(spark, t, "one").select("offset").distinct().count() == 30
    assert read_batch(spark, t, "two").count() == 10


def test_oversample_partitions_grow_with_the_input(spark, monkeypatch):
    """The distinct ids of a task are bounded by input bytes; only the ids before copying are exchanged."""
    from fraudlens.plans import joins
    counted = lambda: _plan(Q.QUERIES["oversample"](spark, SF_SMALL))
    few = int(re.search(r"hashpartitioning\(pq#\d+, (\d+)\)", counted()).group(1))
    monkeypatch.setattr(joins, "PARTITION_BYTES", 1000)
    plan = counted()
    assert int(re.search(r"hashpartitioning\(pq#\d+, (\d+)\)", plan).group(1)) > few
    assert not re.search(r"hashpartitioning\([^)]*copy[^)]*pq", plan)
