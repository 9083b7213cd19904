"""Stream = batch, checkpointed restart, rate limit, state guard."""

import json

import pytest
from pyspark.sql import functions as F

from tables import SF_SMALL
from fraudlens.folder import Folder
from fraudlens.operators.reports import report
from fraudlens.plans.queries import QUERIES
from fraudlens.schemas import ENVELOPE_SCHEMA
from fraudlens.sinks.publish import publish, write_envelopes
from fraudlens.sources.envelope import decode_transactions, files, read_batch, read_stream
from fraudlens.streaming import stream as st


def _write_file(spark, t, rows, start):
    data = [(None, json.dumps(r).encode(), "tx", 0, start + i, None, 0) for i, r in enumerate(rows)]
    write_envelopes(spark, spark.createDataFrame(data, ENVELOPE_SCHEMA).coalesce(1), t)


def _rec(i, cat, lab):
    return {"transaction_id": f"t{i}", "category": cat, "fraud_label": str(lab)}


def test_stream_equals_batch_and_restart(spark, scratch):
    t = files(scratch("st-topics"))
    _write_file(spark, t, [_rec(i, "A", i % 2) for i in range(4)], 0)
    _write_file(spark, t, [_rec(i, "B", 1) for i in range(4, 6)], 10)
    out, ckpt = scratch("st-out"), scratch("st-ckpt")

    def run():
        rec = decode_transactions(read_stream(spark, t, "tx", max_per_trigger=1))
        q = st.to_table_snapshot(st.running_report(rec, "fraud_category"), out, ckpt)
        st.run_to_end(q)
        return q

    q = run()
    assert len(q.recentProgress) >= 2                  # one file per micro-batch
    batch = report("fraud_category", decode_transactions(read_batch(spark, t, "tx")))
    as_set = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert as_set(spark.read.parquet(out)) == as_set(batch)

    _write_file(spark, t, [_rec(9, "A", 1)], 20)       # new file after the run
    q2 = run()
    processed = sum(p["numInputRows"] for p in q2.recentProgress)
    assert processed == 1                              # restart reads only the new file
    got = {r.category: (r.fraud_count, r.total_transactions) for r in spark.read.parquet(out).collect()}
    assert got == {"A": (3, 5), "B": (2, 2)}


def test_append_file_sink(spark, scratch):
    t = files(scratch("st2"))
    _write_file(spark, t, [_rec(i, "A", 0) for i in range(3)], 0)
    out = scratch("st2-out")
    q = st.to_files(st.raw_values(read_stream(spark, t, "tx")), out, scratch("st2-ckpt"))
    st.run_to_end(q)
    assert spark.read.parquet(out).count() == 3


def test_unbounded_state_refused(spark, scratch):
    t = files(scratch("st3"))
    _write_file(spark, t, [_rec(0, "A", 0)], 0)
    rec = decode_transactions(read_stream(spark, t, "tx"))
    running = st.running_report(rec, "income_analytics")
    for refused in (lambda: st.to_table_snapshot(running, scratch("o"), scratch("c")),
                    lambda: st.fan_out(rec, ["income_analytics"], print, scratch("c")),
                    lambda: st.to_topic(running, t, "x", scratch("c"), mode="complete")):
        with pytest.raises(ValueError, match="unbounded"):
            refused()


def test_open_key_streams_in_update_mode_and_replays_change_nothing(spark, scratch):
    from fraudlens.sinks.keyed import read_table, upsert
    t = files(scratch("st6"))
    rows = [dict(_rec(i, "A", 0), user_income=str(i % 3), total_amount="2.5") for i in range(9)]
    _write_file(spark, t, rows[:6], 0)
    _write_file(spark, t, rows[6:], 10)
    table = scratch("st6-table")

    def run(checkpoint):
        rec = decode_transactions(read_stream(spark, t, "tx", max_per_trigger=1))
        st.run_to_end(st.to_keyed_table(st.running_report(rec, "income_analytics"), "income_analytics",
                                        table, checkpoint))
        return {r.user_income: r.avg_transaction_amount for r in read_table(spark, table).collect()}

    first = scratch("st6-ckpt")
    assert run(first) == {0: 2.5, 1: 2.5, 2: 2.5}
    again = read_table(spark, table)
    upsert(spark, again, table, "_row_key")             # a replayed micro-batch puts the same rows again
    assert run(scratch("st6-ckpt2")) == {0: 2.5, 1: 2.5, 2: 2.5}


def test_rate_limit_by_records(spark, scratch):
    from fraudlens.sinks.publish import write_envelopes
    from fraudlens.sources.fixtures import transaction_envelope
    from tables import SF_SMALL
    t = files(scratch("st7"), records_per_file=100)
    write_envelopes(spark, transaction_envelope(spark, SF_SMALL, "tx").limit(1_500), t)
    q = st.to_files(st.raw_values(read_stream(spark, t, "tx", max_per_trigger=300)), scratch("o"), scratch("c"))
    st.run_to_end(q)
    sizes = st.batch_sizes(q)
    assert sum(sizes) == 1_500 and len(sizes) >= 5 and max(sizes) <= 300


def test_latest_is_fixed_when_the_checkpoint_first_asks(spark, scratch):
    t, out, ckpt = files(scratch("st8")), scratch("o"), scratch("c")
    _write_file(spark, t, [_rec(i, "A", 0) for i in range(4)], 0)
    with pytest.raises(ValueError, match="checkpoint"):
        read_stream(spark, t, "tx", starting="latest")
    seen = []
    for first in (10, 20):
        env = read_stream(spark, t, "tx", starting="latest", checkpoint=ckpt)
        st.run_to_end(st.to_files(st.raw_values(env), out, ckpt))
        seen.append(spark.read.parquet(out).count())
        _write_file(spark, t, [_rec(i, "A", 0) for i in range(3)], first)
    env = read_stream(spark, t, "tx", starting="latest", checkpoint=ckpt)
    st.run_to_end(st.to_files(st.raw_values(env), out, ckpt))
    assert [*seen, spark.read.parquet(out).count()] == [0, 3, 6]


def test_counts_are_observed_while_a_stream_passes(spark, scratch):
    t = files(scratch("st9"))
    for k in range(3):
        _write_file(spark, t, [_rec(i, "A" if i else None, 0) for i in range(5)], 10 * k)
    rec = decode_transactions(read_stream(spark, t, "tx", max_per_trigger=1))
    q = st.to_files(st.counted(rec, "audit", with_category="category"), scratch("o"), scratch("c"))
    st.run_to_end(q)
    assert st.observed_totals(q, "audit") == {"rows": 15, "with_category": 12}


def test_run_to_end_has_no_default_limit():
    import inspect
    assert inspect.signature(st.run_to_end).parameters["timeout_s"].default is None


def test_topic_sink_complete_mode(spark, scratch):
    t = files(scratch("st4"))
    _write_file(spark, t, [_rec(i, "A" if i % 2 else "B", 1) for i in range(6)], 0)
    _write_file(spark, t, [_rec(9, "A", 0)], 10)
    rec = decode_transactions(read_stream(spark, t, "tx", max_per_trigger=1))
    out = files(scratch("st4-out"))
    q = st.to_topic(st.running_report(rec, "fraud_category"), out, "fraud_category",
                    scratch("st4-ckpt"), mode="complete")
    st.run_to_end(q)
    from fraudlens.sources.envelope import decode
    from pyspark.sql import functions as F
    env = read_batch(spark, out, "fraud_category")
    schema = "category string, fraud_count long, total_transactions long, fraud_percentage double"
    from pyspark.sql.types import _parse_datatype_string
    latest = {}
    for r in decode(env, _parse_datatype_string(schema), keep=("offset",)).collect():
        if r.category not in latest or r.offset > latest[r.category][0]:
            latest[r.category] = (r.offset, r.fraud_count, r.total_transactions)
    assert {k: v[1:] for k, v in latest.items()} == {"A": (3, 4), "B": (3, 3)}


def test_console_sink_runs(spark, scratch):
    t = files(scratch("st5"))
    _write_file(spark, t, [_rec(0, "A", 0)], 0)
    q = st.to_console(st.raw_values(read_stream(spark, t, "tx")), checkpoint=scratch("st5-ckpt"))
    st.run_to_end(q)
    assert q.lastProgress["numInputRows"] == 1


def test_shares_of_a_file_topic_are_disjoint_and_whole(spark, scratch):
    root = scratch("shares")
    t = files(root, records_per_file=10)
    publish(spark, spark.range(235).select(F.col("id").cast("string").alias("v")).coalesce(2), t, "tx")
    outs, running = [], []
    for k in range(10):
        env = read_stream(spark, t, "tx", max_per_trigger=20, share=(k, 10))
        outs.append(scratch(f"share-{k}"))
        running.append(st.to_files(st.raw_values(env), outs[-1], scratch(f"share-c{k}")))
    st.run_all_to_end(running)
    assert sum(len(st.batch_sizes(q)) for q in running) > 5
    assert all(n <= 20 for q in running for n in st.batch_sizes(q))
    schema = "topic string, partition int, offset long, value string"
    found = [r.value for out in outs for r in spark.read.schema(schema).parquet(out).collect()]
    assert sorted(found) == sorted('{"v":"%d"}' % i for i in range(235))
    spark.range(1).selectExpr("cast(null as binary) AS value").write.option("compression", "lz4_raw").mode(
        "append").parquet(t.topic_path("tx"))                        # a later part of the name ends in no digit
    read_stream(spark, t, "tx", share=(1, 2))
    Folder(spark, t.topic_path("tx")).write("foreign.parquet", {})
    with pytest.raises(ValueError, match="foreign.parquet"):
        read_stream(spark, t, "tx", share=(1, 2))


def test_rate_limited_readers_write_one_file_a_batch(spark):
    found = QUERIES["stream_rate_limited"](spark, SF_SMALL)
    names = {r.f for r in found.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len({n.rsplit("/", 1)[0] for n in names}) > 1                 # several readers shared the topic
    assert found.where("bounded AND several").count() == found.count() > 0


def test_rate_limited_topic_is_listed_once_and_logs_are_light(spark, monkeypatch):
    """Ten readers look at the names of a topic of many files once, and their
    logs are renamed without a process for every path."""
    listed, managers = [], []
    names, to_files = Folder.names, st.to_files
    monkeypatch.setattr(Folder, "names", lambda self, name="": (listed.append(self.path), names(self, name))[1])
    monkeypatch.setattr(st, "to_files", lambda *a: (managers.append(spark.conf.get(st._MANAGER, None)), to_files(*a))[1])
    assert QUERIES["stream_rate_limited"](spark, SF_SMALL).count() > 0
    assert len([p for p in listed if p.endswith("topic=transactions")]) == 1
    assert len(managers) > 1 and all(m and m.endswith(".FileSystemBasedCheckpointFileManager") for m in managers)
    assert spark.conf.get(st._MANAGER, None) is None


def test_light_logs_are_read_without_them(spark, scratch):
    t, out, checkpoint = files(scratch("light")), scratch("light-out"), scratch("light-c")
    with st.light_logs(spark, t.root):
        for k in range(12):                                          # more than one rewrite of the logs
            publish(spark, spark.range(k, k + 1), t, "tx")
            st.run_to_end(st.to_files(st.raw_values(read_stream(spark, t, "tx")), out, checkpoint))
    publish(spark, spark.range(12, 13), t, "tx")
    st.run_to_end(st.to_files(st.raw_values(read_stream(spark, t, "tx")), out, checkpoint))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == sorted('{"id":%d}' % i for i in range(13))
    later = scratch("light-later")
    for _ in range(2):                                               # a restart with the same number goes on
        with st.light_logs(spark, t.root, rewrite_every=5):
            q = st.to_files(st.raw_values(read_stream(spark, t, "tx", max_per_trigger=1)), out + "-5", later)
            st.run_to_end(q)
    assert spark.read.parquet(out + "-5").count() == 13
    rewritten = [int(n.split(".")[0]) for n in Folder(spark, later).names("sources/0") if n.endswith(".compact")]
    assert len(rewritten) > 1 and all(batch % 5 == 4 for batch in rewritten)
    assert spark.conf.get(st._REWRITE) == "10"
    spark.conf.set(st._MANAGER, "named.Manager")                     # the session's own choice stays
    try:
        with st.light_logs(spark, t.root):
            assert spark.conf.get(st._MANAGER) == "named.Manager"
        assert spark.conf.get(st._MANAGER) == "named.Manager"
    finally:
        spark.conf.unset(st._MANAGER)


def test_names_of_a_folder(spark, scratch):
    folder = Folder(spark, scratch("names"))
    assert folder.names() == [] and folder.names("none") == []
    wanted = ["a b.json", "part-1 é%20.json", "z,y.json"]
    for name in wanted:
        folder.write(f"sub/{name}", {})
    assert folder.names("sub") == wanted and folder.names() == ["sub"] and folder.is_local


def test_reports_of_few_keys_take_few_tasks_and_state_stores(spark, scratch, monkeypatch):
    """State stores and tasks of a micro-batch do not follow the session's shuffle partitions."""
    t = files(scratch("few"))
    _write_file(spark, t, [_rec(i, f"c{i % 3}", i % 2) for i in range(30)], 0)
    before, sliced = spark.conf.get("spark.sql.shuffle.partitions"), []
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rec = decode_transactions(read_stream(spark, t, "tx"))
        q = st.fan_out(rec, ["fraud_category", "fraud_device"], lambda e, frames: sliced.extend(
            (df.rdd.getNumPartitions(), df.count()) for df in frames.values()), scratch("few-c"))
        st.run_to_end(q)
        assert sliced == [(1, 3), (1, 1)]
        assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == st.STATE_PARTITIONS
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
