"""Keyed upsert (latest wins, null keys rejected, idempotent rerun), cells,
CSV round trip and the ingest job."""

import pytest
from pyspark.sql import functions as F

from fraudlens.operators.cells import to_cells
from fraudlens.operators.rows import available, is_empty, normalize_supply, oversample
from fraudlens.plans.jobs import ingest_csv
from fraudlens.schemas import SUPPLY_SCHEMA
from fraudlens.sinks.files import write_csv
from fraudlens.sinks.keyed import read_table, upsert
from fraudlens.sources.csv import read_csv
from fraudlens.sources.envelope import decode, files, read_batch

ROWS = "k string, a string, b double, ts long, p int, o long"


def test_upsert_latest_wins(spark, scratch):
    path = scratch("table")
    order = ["ts", "p", "o"]
    b1 = spark.createDataFrame([("k1", "x", 1.0, 1, 0, 1), ("k2", "y", 2.0, 1, 0, 2),
                                (None, "z", 0.0, 1, 0, 3)], ROWS)
    r1 = upsert(spark, b1, path, "k", order)
    assert r1.rows_in == 3 and r1.rejected_null_keys == 1
    b2 = spark.createDataFrame([("k1", "x2", 5.0, 2, 0, 5), ("k1", "x3", None, 2, 0, 6),
                                ("k2", "old", 9.0, 0, 0, 1)], ROWS)
    upsert(spark, b2, path, "k", order)
    got = {r.k: (r.a, r.b) for r in read_table(spark, path).collect()}
    assert got == {"k1": ("x3", None), "k2": ("y", 2.0)}   # null cell of the winner kept
    upsert(spark, b2, path, "k", order)          # rerun changes nothing
    again = {r.k: (r.a, r.b) for r in read_table(spark, path).collect()}
    assert again == got


def _stored(spark, path, key="k"):
    return {r[key]: r for r in read_table(spark, path).collect()}


def test_key_and_order_belong_to_the_table(spark, scratch):
    path = scratch("table")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int")
    upsert(spark, df, path, "k", ["v"])
    for other in (dict(key="v", order_cols=["v"]), dict(key="k", order_cols=[])):
        with pytest.raises(ValueError):
            upsert(spark, df, path, **other)
    upsert(spark, df, path, "k", ["v"])
    assert read_table(spark, path).count() == 20


def test_absent_columns_keep_their_value(spark, scratch):
    path = scratch("table")
    full = spark.createDataFrame([(f"k{i}", 1, f"a{i}", f"b{i}") for i in range(20)], "k string, v int, a string, b string")
    upsert(spark, full, path, "k", ["v"])
    upsert(spark, spark.createDataFrame([("k3", 2, "new")], "k string, v int, a string"), path, "k", ["v"])
    upsert(spark, spark.createDataFrame([("k4", 3, None)], "k string, v int, b string"), path, "k", ["v"])
    got = _stored(spark, path)
    assert len(got) == 20 and (got["k3"].a, got["k3"].b, got["k3"].v) == ("new", "b3", 2)
    assert (got["k4"].a, got["k4"].b) == ("a4", None)      # a null that was put is a value
    assert all((got[f"k{i}"].a, got[f"k{i}"].b) == (f"a{i}", f"b{i}") for i in range(5, 20))


def test_unreadable_table_is_an_error_and_loses_nothing(spark, scratch):
    import os
    path = scratch("table")
    local = path.removeprefix("file:")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int")
    upsert(spark, df, path, "k", ["v"])
    good = open(f"{local}/_table.json").read()
    if os.path.exists(f"{local}/._table.json.crc"):
        os.remove(f"{local}/._table.json.crc")
    open(f"{local}/_table.json", "w").write("{broken")
    with pytest.raises(Exception):
        upsert(spark, df.limit(2), path, "k", ["v"])
    open(f"{local}/_table.json", "w").write(good)
    assert read_table(spark, path).count() == 20


def test_null_and_empty_report_keys_stay_apart(spark, scratch):
    from fraudlens.operators.reports import report
    from fraudlens.plans.jobs import store_reports
    rows = [("t1", None, 1), ("t2", "", 0), ("t3", "", 1), ("t4", "x", 0)]
    df = spark.createDataFrame(rows, "transaction_id string, category string, fraud_label int")
    path = scratch("reports")
    store_reports(spark, {"fraud_category": report("fraud_category", df)}, path)
    assert set(_stored(spark, path, "row_key")) == {"fraud_category", "fraud_category#", "fraud_category#x"}


def test_failed_task_leaves_nothing(spark, scratch):
    from fraudlens.folder import Folder
    path = scratch("table")
    good = spark.createDataFrame([("k", 1)], "k string, v int")
    upsert(spark, good, path, "k", ["v"])
    bad = spark.range(40).repartition(8).selectExpr(
        "concat('k', id) AS k", "CAST(IF(id = 17, raise_error('lost'), id) AS INT) AS v")
    with pytest.raises(Exception, match="lost"):
        upsert(spark, bad, path, "k", ["v"])
    assert [tuple(r) for r in read_table(spark, path).collect()] == [("k", 1)]
    assert len([n for n in Folder(spark, path).names() if n.startswith("put-")]) == 1
    upsert(spark, good.selectExpr("k", "v + 1 AS v"), path, "k", ["v"])
    assert _stored(spark, path)["k"].v == 2


def test_files_of_uncommitted_attempts_are_not_read(spark, scratch):
    import glob
    import shutil
    path = scratch("table")
    upsert(spark, spark.createDataFrame([("k", 1)], "k string, v int"), path, "k", ["v"])
    (own,) = glob.glob(f"{path.removeprefix('file:')}/put-*/part-*.parquet")
    shutil.copy(own, own.replace("part-", "part-9"))                # a lost attempt's file beside the named one
    assert read_table(spark, path).count() == 1
    other = path.removeprefix("file:") + "/put-0123456789ab-" + "9" * 20 + "-x"
    shutil.copytree(own.rsplit("/", 1)[0], other, ignore=shutil.ignore_patterns("_committed*"))
    assert read_table(spark, path).count() == 1


def test_two_writers_lose_no_row(spark, scratch):
    """Both start from the same table, and the one that started first ends last."""
    from concurrent.futures import ThreadPoolExecutor

    from fraudlens.sinks import keyed
    path = scratch("table")
    upsert(spark, spark.createDataFrame([("k0", 0, 0)], "k string, v int, at int"), path, "k", ["at"])
    rows = {w: [(f"k{i}", w, 10 * i + w) for i in range(w, 30, w)] for w in (1, 2, 3)}
    with ThreadPoolExecutor(3) as pool:
        for f in [pool.submit(upsert, spark, spark.createDataFrame(r, "k string, v int, at int"), path, "k", ["at"])
                  for r in rows.values()]:
            f.result()
    want = {"k0": 0}
    for own in rows.values():
        for k, v, at in own:
            want[k] = max(want.get(k, 0), at)
    assert {k: r.at for k, r in _stored(spark, path).items()} == want
    # Interleaved by hand: the version is taken before another writer's whole put.
    folder, late = keyed.Folder(spark, path), spark.createDataFrame([("k1", 9, 1_000, 1)], "k string, v int, at int, _put long")
    upsert(spark, spark.createDataFrame([("k1", 8, 900), ("new", 8, 1)], "k string, v int, at int"), path, "k", ["at"])
    keyed._write_put(late, folder, 1)
    got = _stored(spark, path)
    assert (got["k1"].v, got["new"].v, len(got)) == (9, 8, len(want) + 1)


def test_compaction_keeps_rows_and_versions(spark, scratch):
    from fraudlens.sinks import keyed
    path = scratch("table")
    for i in (3, 5, 4):
        upsert(spark, spark.createDataFrame([("k", i, f"a{i}"), (f"only{i}", i, "x")], "k string, v int, a string"),
               path, "k", ["v"])
    upsert(spark, spark.createDataFrame([("k", 6)], "k string, v int"), path, "k", ["v"])
    before = sorted(map(tuple, read_table(spark, path).select("k", "v", "a").collect()))
    assert before[0] == ("k", 6, "a5")
    keyed.compact(spark, path)
    assert sorted(map(tuple, read_table(spark, path).select("k", "v", "a").collect())) == before
    assert len(keyed._puts(keyed.Folder(spark, path))) == 2                      # one per set of columns
    upsert(spark, spark.createDataFrame([("k", 2, "old")], "k string, v int, a string"), path, "k", ["v"])
    assert _stored(spark, path)["k"].a == "a5"


def test_without_order_the_later_put_wins(spark, scratch):
    path = scratch("table")
    for v in (7, 3, 5):
        upsert(spark, spark.createDataFrame([("k", v), (f"o{v}", v)], "k string, v int"), path, "k")
    assert {k: r.v for k, r in _stored(spark, path).items()} == {"k": 5, "o7": 7, "o3": 3, "o5": 5}


def test_offsets_go_on_and_a_failed_publish_blocks_nobody(spark, scratch):
    from fraudlens.sinks.publish import publish
    t = files(scratch("offsets"))
    df = spark.range(30).selectExpr("cast(id as string) as x").repartition(3)
    tops = []
    for k in range(3):
        assert publish(spark, df, t, "a") == 30
        tops.append(read_batch(spark, t, "a").agg(F.max("offset")).first()[0])
        if k == 1:
            with pytest.raises(Exception, match="lost"):
                publish(spark, df.selectExpr("IF(x = '17', raise_error('lost'), x) AS x"), t, "a")
            assert read_batch(spark, t, "a").count() == 60
    assert read_batch(spark, t, "a").select("offset").distinct().count() == 90
    assert tops == sorted(set(tops)) and tops[-1] < 3 * 31 * (1 << 21)      # far from 2^63


def test_report_messages_share_a_partition_by_key(spark, scratch):
    from fraudlens.sinks.publish import publish
    t = files(scratch("keyed-topic"))
    for v in range(4):
        publish(spark, spark.createDataFrame([("a", v), (None, v), ("", v)], "k string, v int"), t, "r", key_col="k")
    rows = read_batch(spark, t, "r").select(F.col("key").cast("string").alias("k"), "partition").distinct().collect()
    assert len(rows) == 3


def test_csv_quotes_commas_backslashes_and_headers(spark, scratch):
    rows = [('P1', 'He said "hi", ok', 'Asia'), ('P2', 'ends in \\', 'x,y'), ('P3', 'tab\t"', ''), ('P4', None, '"')]
    df = spark.createDataFrame(rows, "Project string, Vendor string, Country string")
    path = scratch("csv")
    write_csv(df.coalesce(1), path)
    assert sorted(map(tuple, read_csv(spark, path).collect())) == sorted(rows)
    raw = "".join(r.value + "\n" for r in spark.read.text(path).collect())
    assert '"He said ""hi"", ok"' in raw and '\\"' not in raw.replace('\\""', '')
    lines = scratch("csv2")
    write_csv(spark.createDataFrame([("a\nb", "c")], "x string, y string"), lines)
    assert [tuple(r) for r in read_csv(spark, lines, multi_line=True).collect()] == [("a\nb", "c")]
    other = scratch("csv3")
    write_csv(df.coalesce(1), other)
    write_csv(df.select("Country", "Project", "Vendor").coalesce(1), other, mode="append")
    with pytest.raises(Exception):
        read_csv(spark, other).collect()               # reordered headers are refused, not shifted


def test_histogram_drops_nan_and_infinite(spark):
    from fraudlens.operators.dashboard import histogram
    values = [0.0, 1.0, 2.0, 10.0, float("nan"), float("inf"), float("-inf"), None]
    got = histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", 5).collect()
    assert sorted((r.bin, r["count"]) for r in got) == [(0, 2), (1, 1), (4, 1)]


def test_supply_records_in_every_spelling(spark):
    import json

    from fraudlens.schemas import SUPPLY_FIELDS, SUPPLY_NUMERIC_FIELDS, spellings
    from fraudlens.sources.envelope import decode_supply
    value = lambda k, c: 7 if k == 0 and c in SUPPLY_NUMERIC_FIELDS else "7"     # canonical numbers are numbers
    rows = [(json.dumps({spellings(c)[k % len(spellings(c))]: value(k, c) for c in SUPPLY_FIELDS}),)
            for k in range(9)] + [("not json",), ("{}",)]
    got = decode_supply(spark.createDataFrame(rows, "value string")).collect()
    assert all(r[c] is not None for r in got[:9] for c in SUPPLY_FIELDS)
    assert all(v is None for r in got[9:] for v in r)


def test_shared_folders_can_be_removed(spark, monkeypatch):
    from fraudlens import session
    from fraudlens.folder import Folder
    monkeypatch.setattr(session, "_MADE", [])
    path = session.shared_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    session.shared_dir(spark, "never-written")
    assert session.remove_shared(spark) == 1 and Folder(spark, path).names() == []


def test_cells(spark):
    df = spark.createDataFrame([("r1", "a", None)], "pq string, x string, y string")
    got = sorted(tuple(r) for r in to_cells(df, "pq").collect())
    assert got == [("r1", "cf1", "x", "a"), ("r1", "cf1", "y", "")]


def test_normalize_and_guards(spark):
    df = spark.createDataFrame([("1", "2", "3")],
                               "`cf1:Project Code` string, `PQ#` string, `Freight_Cost_USD` string")
    n = normalize_supply(df)
    assert n.columns == ["project_code", "pq", "freight_cost_usd"]
    assert available(n, ["pq"]) and not available(n, ["vendor"])
    assert not is_empty(n) and is_empty(n.where(F.lit(False)))


def test_oversample_copies(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert sorted(tuple(r) for r in oversample(df, 3).collect()) == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]


def test_csv_roundtrip_and_ingest(spark, scratch):
    src = spark.createDataFrame(
        [("PC-1", "PQ-1", "Asia", "12kg", "1"), ("PC-2", "PQ-2", None, "abc", "0")],
        "`Project Code` string, `PQ#` string, Country string, `Freight Cost (USD)` string, `Fraud Label` string")
    path = scratch("csv")
    write_csv(src, path)
    back = read_csv(spark, path)
    assert back.columns == src.columns and back.count() == 2
    t = files(scratch("ingest"))
    assert ingest_csv(spark, path, t, "supply") == 2
    rec = decode(read_batch(spark, t, "supply"), SUPPLY_SCHEMA).collect()
    got = sorted((r.project_code, r.country, r.freight_cost_usd, r.fraud_label) for r in rec)
    assert got == [("PC-1", "Asia", 12.0, "1"), ("PC-2", None, None, "0")]


def test_generator_csv_feeds_ingest(spark, scratch):
    """Generator CSV (display headers) -> ingest -> topic: every row arrives
    with canonical names and parsed numbers."""
    from fraudlens.plans.jobs import generate_csv
    from fraudlens.sources.synth import synth_supply
    path = scratch("gen")
    generate_csv(spark, path, rows=500, seed=11)
    header = read_csv(spark, path).columns
    assert "Project Code" in header and "Freight Cost (USD)" in header
    t = files(scratch("gen-topic"))
    assert ingest_csv(spark, path, t, "supply_chain_transactions") == 500
    rec = decode(read_batch(spark, t, "supply_chain_transactions"), SUPPLY_SCHEMA)
    src = synth_supply(spark, rows=500, seed=11)
    a = sorted((r.pq, r.freight_cost_usd, r.fraud_label) for r in rec.collect())
    b = sorted((r.pq, r.freight_cost_usd, str(r.fraud_label)) for r in src.collect())
    assert a == b


def test_wide_rows_are_ranked_by_their_places(spark, scratch, monkeypatch):
    """Rows of many columns: only keys and versions are exchanged, and the rows
    found are those of the plain rank (ties, null versions, several files,
    more rows than one bitmap holds)."""
    from fraudlens.sinks import keyed
    path = scratch("wide-table")
    wide = [F.concat(F.lit(f"c{j}-"), F.col("id")).alias(f"c{j}") for j in range(20)]
    for seed, n in ((1, 90_000), (2, 50_000), (3, 50)):
        rows = spark.range(n).coalesce(2).select(
            F.concat(F.lit("k"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(60_000))).alias("k"),
            F.when(F.col("id") % 7 != 0, F.col("id") % 100).alias("v"), *wide)
        keyed.upsert(spark, rows, path, "k", ["v"])
    found = keyed.read_table(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert found.count() == found.select("k").distinct().count()
    version = lambda df: df.select("k", "v")
    folder, table, puts = keyed._state(spark, path)
    plain = keyed._newest(keyed._by_columns(spark, folder, puts)[0], table).drop(keyed.PUT)
    assert version(found).exceptAll(version(plain)).count() == version(plain).exceptAll(version(found)).count() == 0
    before = version(found).localCheckpoint()
    all_rows = keyed._by_columns(spark, folder, puts)[0].drop(keyed.PUT)
    assert found.exceptAll(all_rows).count() == 0                         # whole rows, unchanged
    keyed.compact(spark, path)
    assert len(keyed._puts(folder)) == 1
    assert version(keyed.read_table(spark, path)).exceptAll(before).count() == 0
    assert [r.k for r in keyed.read_table(spark, path, ["k5"]).collect()] == ["k5"]
    monkeypatch.setattr("fraudlens.plans.joins.is_bounded", lambda *a: False)
    assert keyed.read_table(spark, path).count() == before.count()        # bitmaps too large to broadcast
