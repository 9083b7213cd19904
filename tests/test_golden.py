"""Golden rows of FIXTURES.md section 5 (sf0.01), reproduced by our views."""

import math

import pytest

from fraudlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _rows(spark, name, key):
    return {r[key]: r for r in QUERIES[name](spark, SF).collect()}


def test_fraud_category_golden(spark):
    got = _rows(spark, "fraud_category", "category")
    assert (got["ECONOMY"].fraud_count, got["ECONOMY"].total_transactions) == (1345, 7810)
    assert got["ECONOMY"].fraud_percentage == 17.221510883482715
    assert (got[None].fraud_count, got[None].total_transactions) == (175, 1073)
    assert len(got) == 7


def test_fraud_age_and_income_golden(spark):
    age = _rows(spark, "fraud_age", "age_group")
    assert {k: (r.fraud_count, r.total_transactions) for k, r in age.items()} == {
        "Under 20": (744, 4287), "20-29": (1427, 8428), "30-39": (1424, 8326),
        "40-49": (1496, 8574), "50+": (3482, 21196), None: (94, 591)}
    inc = _rows(spark, "fraud_income", "income_group")
    assert (inc["140k+"].fraud_count, inc["140k+"].total_transactions) == (2462, 14407)


def test_supply_golden(spark):
    fc = _rows(spark, "fraud_freight_cost", "cost_group")
    assert {k: (r.fraud_count, r.total_orders) for k, r in fc.items()} == {
        "Low Cost": (1956, 11701), "Medium Cost": (4030, 24034),
        "High Cost": (2510, 14647), None: (171, 1020)}
    sm = _rows(spark, "shipment_mode_counts", "shipment_mode")
    assert {k: r["count"] for k, r in sm.items()} == {"Air": 25644, "Road": 17205, "Sea": 17151}
    fca = QUERIES["freight_cost_analytics"](spark, SF).first()
    assert (fca.max_freight_cost, fca.min_freight_cost) == (2099.9576, 18.0364)
    ls = _rows(spark, "label_share_product_group", "product_group")
    assert math.isclose(ls["ECONOMY"].pct_label_0, 84.59159124756559, rel_tol=1e-12)


def test_auc_and_index_golden(spark):
    auc = QUERIES["auc_fraud_probability"](spark, SF).first().auc
    assert abs(auc - 0.4746406324859347) < 1e-9
    idx = {r.shipment_mode: r.shipment_mode_index
           for r in QUERIES["index_shipment_mode"](spark, SF).collect()}
    assert idx == {"Air": 0.0, "Road": 1.0, "Sea": 2.0}
