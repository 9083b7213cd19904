"""Report semantics (N3, N4, N5, N7, N11) and the fused form."""

import math

from pyspark.sql import functions as F

from fraudlens.operators import dashboard, fused
from fraudlens.operators.reports import ECOMMERCE_FRAUD, REPORTS, report
from fraudlens.plans.jobs import report_set
from fraudlens.sources import fixtures
from tables import SF_SMALL

TX = "transaction_id string, category string, fraud_label int, user_age int, user_income int, payment_method string, user_device string, user_city string, total_amount double"


def _tx(spark, rows):
    full = []
    for r in rows:
        tid, cat, lab = r
        full.append((tid, cat, lab, 30, 50000, "card", "Mobile", "X", 10.0))
    return spark.createDataFrame(full, TX)


def _by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_zero_denominator_and_over_100(spark):
    df = _tx(spark, [
        (None, "A", 1), (None, "A", 0),             # ids all null -> null share
        (None, "B", 0),
        ("t1", "C", 1), (None, "C", 1),             # 2 frauds / 1 id -> 200 %
        ("t2", "D", None), ("t3", "D", 1),          # null label: not fraud, counted
    ])
    out = _by_key(report("fraud_category", df), "category")
    assert out["A"]["fraud_count"] == 1 and out["A"]["total_transactions"] == 0
    assert out["A"]["fraud_percentage"] is None
    assert out["B"]["fraud_percentage"] is None
    assert out["C"]["fraud_percentage"] == 200.0
    assert out["D"]["fraud_count"] == 1 and out["D"]["total_transactions"] == 2
    assert out["D"]["fraud_percentage"] == 50.0


def test_null_key_kept_in_reports_dropped_in_dashboard(spark):
    df = spark.createDataFrame(
        [(None, "1", "PC-1", 1.0), ("X", "0", "PC-2", 2.0), ("X", None, None, None)],
        "product_group string, fraud_label string, project_code string, line_item_quantity double")
    rep = _by_key(report("fraud_product_group", df), "product_group")
    assert None in rep and rep[None]["fraud_count"] == 1
    share = _by_key(dashboard.label_share(df, "product_group"), "product_group")
    assert list(share) == ["X"] and share["X"]["pct_label_0"] == 100.0
    qty = _by_key(report("quantity_by_product_group", df), "product_group")
    assert list(qty) == ["X"] and qty["X"]["total_quantity"] == 2.0


def test_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([("PC-1", None), ("PC-1", None), ("PC-2", 3.0)],
                               "project_code string, freight_cost_usd double")
    out = _by_key(report("freight_by_project", df), "project_code")
    assert out["PC-1"]["total_freight_cost"] == 0.0
    assert out["PC-2"]["total_freight_cost"] == 3.0


def test_fused_equals_separate(spark):
    tx = fixtures.transactions(spark, SF_SMALL)
    sep = report_set(tx, ECOMMERCE_FRAUD, "separate")
    fus = report_set(tx, ECOMMERCE_FRAUD, "fused")
    for name in ECOMMERCE_FRAUD:
        a = sorted(map(tuple, sep[name].collect()), key=str)
        b = sorted(map(tuple, fus[name].collect()), key=str)
        assert a == b, name


def test_grouping_id_separates_null_key_from_other_sets(spark):
    df = _tx(spark, [(None, None, 1), ("t1", "A", 0)])
    agg = fused.fused_aggregate(df, ["fraud_category", "fraud_payment"])
    parts = fused.split_fused(agg, ["fraud_category", "fraud_payment"])
    cats = _by_key(parts["fraud_category"], "category")
    assert set(cats) == {None, "A"}
    pays = _by_key(parts["fraud_payment"], "payment_method")
    assert set(pays) == {"card"} and pays["card"]["fraud_count"] == 1


def test_histogram_edges(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [0, 5, 10, 20, None]], "freight_cost_usd double")
    h = {r["bin"]: r["count"] for r in dashboard.histogram(df, "freight_cost_usd", bins=4).collect()}
    assert h == {0: 1, 1: 1, 2: 1, 3: 1}           # max lands in the last bin
    const = spark.createDataFrame([(7.0,), (7.0,)], "freight_cost_usd double")
    assert [(r["bin"], r["count"]) for r in dashboard.histogram(const, "freight_cost_usd").collect()] == [(0, 2)]


def test_value_counts_order(spark):
    df = spark.createDataFrame([(m,) for m in ["Sea", "Air", "Air", "Road", "Sea", None]], "shipment_mode string")
    got = [(r[0], r[1]) for r in dashboard.value_counts(df, "shipment_mode").collect()]
    assert got == [("Air", 2), ("Sea", 2), ("Road", 1)]


def test_report_inputs_are_narrow():
    assert REPORTS["fraud_age"].inputs == ["user_age", "fraud_label", "transaction_id"]


def test_dashboard_tables_equal_single_queries(spark):
    from fraudlens.plans.queries import QUERIES
    sc = fixtures.supply_lines(spark, SF_SMALL)
    fusedd = dashboard.dashboard_tables(sc)
    for name, df in fusedd.items():
        single = QUERIES[name](spark, SF_SMALL)
        a = sorted(map(tuple, df.collect()), key=str)
        b = sorted(map(tuple, single.collect()), key=str)
        assert len(a) == len(b), name
        for ra, rb in zip(a, b):          # edges/sums are rounded on the query side
            for x, y in zip(ra, rb):
                if isinstance(x, float):
                    assert math.isclose(x, y, rel_tol=1e-9), (name, ra, rb)
                else:
                    assert x == y, (name, ra, rb)


def test_available_reports(spark):
    from fraudlens.operators.reports import available_reports
    df = spark.createDataFrame([], "product_group string, fraud_label string, project_code string")
    got = available_reports(df)
    assert "fraud_product_group" in got and "fraud_country" not in got
    assert "fraud_category" not in got
