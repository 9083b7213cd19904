"""Declarative grouped reports.

A ``ReportSpec`` names a grouping key (a column or a derived bucket), a list
of measures and the input fields it reads.  ``run_report`` turns it into one
``groupBy().agg()``: Catalyst plans a partial (map-side) hash aggregate, a
shuffle of one row per key and map task, and a final aggregate.  Because
every measure is algebraic (count, sum, min, max, avg), a key holding a
third of all rows is collapsed inside each map task and never lands on a
single reducer as raw rows.

The same spec runs on a batch or a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import (
    age_group,
    cost_group,
    income_group,
    is_fraud_int,
    is_fraud_str,
)

ColumnFn = Callable[[], Column]


@dataclass(frozen=True)
class Measure:
    name: str
    expr: ColumnFn            # aggregate expression (built lazily)
    inputs: tuple[str, ...]   # record fields it reads


@dataclass(frozen=True)
class ReportSpec:
    name: str                           # query key, default topic name
    family: str                         # "tx" (transactions) or "sc" (supply)
    key: str | None                     # output key column; None = global
    measures: tuple[Measure, ...]
    key_expr: ColumnFn | None = None    # derived key (bucket); default col(key)
    key_inputs: tuple[str, ...] = ()    # fields the derived key reads
    drop_null_keys: bool = False        # dashboard policy: null keys dropped
    topic: str | None = None

    @property
    def inputs(self) -> list[str]:
        cols: list[str] = []
        if self.key is not None:
            cols += list(self.key_inputs) if self.key_expr else [self.key]
        for m in self.measures:
            cols += list(m.inputs)
        return list(dict.fromkeys(cols))

    def key_column(self) -> Column:
        return self.key_expr() if self.key_expr else F.col(self.key)

    @property
    def output_topic(self) -> str:
        return self.topic or self.name


def run_report(spec: ReportSpec, df: DataFrame) -> DataFrame:
    """Evaluate one report over a batch or streaming DataFrame."""
    aggs = [m.expr().alias(m.name) for m in spec.measures]
    if spec.key is None:
        return df.agg(*aggs)
    keyed = df.select(spec.key_column().alias(spec.key),
                      *[F.col(c) for c in spec.inputs if c != spec.key])
    if spec.drop_null_keys:
        keyed = keyed.where(F.col(spec.key).isNotNull())
    return keyed.groupBy(spec.key).agg(*aggs)


# ---------------------------------------------------------------------------
# Measure builders
# ---------------------------------------------------------------------------

def m_count(name: str, c: str) -> Measure:
    return Measure(name, lambda: F.count(F.col(c)), (c,))


def m_avg(name: str, c: str) -> Measure:
    return Measure(name, lambda: F.avg(F.col(c)), (c,))


def m_sum(name: str, c: str) -> Measure:
    return Measure(name, lambda: F.sum(F.col(c)), (c,))


def m_sum0(name: str, c: str) -> Measure:
    """Sum where an all-null group gives 0 (dashboard rule)."""
    return Measure(name, lambda: F.coalesce(F.sum(F.col(c)), F.lit(0)), (c,))


def m_min(name: str, c: str) -> Measure:
    return Measure(name, lambda: F.min(F.col(c)), (c,))


def m_max(name: str, c: str) -> Measure:
    return Measure(name, lambda: F.max(F.col(c)), (c,))


def _fraud_count(label: str, string_label: bool) -> Column:
    flag = is_fraud_str(label) if string_label else is_fraud_int(label)
    return F.count(F.when(flag, 1))


def fraud_measures(id_col: str, total_name: str, label: str = "fraud_label",
                   string_label: bool = False) -> tuple[Measure, ...]:
    """fraud_count, total (count of non-null ids) and fraud_percentage.

    The numerator counts label == 1 regardless of the id, the denominator
    counts non-null ids, so a share can exceed 100; a zero denominator gives
    null (``try_divide``) instead of an ANSI error."""
    ins = (label, id_col)
    return (
        Measure("fraud_count", lambda: _fraud_count(label, string_label), (label,)),
        Measure(total_name, lambda: F.count(F.col(id_col)), (id_col,)),
        Measure("fraud_percentage",
                lambda: F.try_divide(_fraud_count(label, string_label),
                                     F.count(F.col(id_col))) * F.lit(100), ins),
    )


def fraud_percentage_sum_form(id_col: str = "transaction_id",
                              label: str = "fraud_label") -> Measure:
    """Fraud share written as sum(when(label == 1, 1).otherwise(0)) / count(id)."""
    return Measure(
        "fraud_percentage",
        lambda: F.try_divide(F.sum(F.when(is_fraud_int(label), 1).otherwise(0)),
                             F.count(F.col(id_col))) * F.lit(100),
        (label, id_col))


# ---------------------------------------------------------------------------
# Catalogue
# ---------------------------------------------------------------------------

TX_ID = "transaction_id"
SC_ORDER_ID = "pq"            # supply summary counts purchase quotes
SC_PROJECT_ID = "project_code"  # supply fraud reports count project codes


def _tx_fraud(name: str, key: str, key_expr=None, key_inputs=()) -> ReportSpec:
    return ReportSpec(name, "tx", key, fraud_measures(TX_ID, "total_transactions"),
                      key_expr=key_expr, key_inputs=tuple(key_inputs))


def _sc_fraud(name: str, key: str, key_expr=None, key_inputs=()) -> ReportSpec:
    return ReportSpec(name, "sc", key,
                      fraud_measures(SC_PROJECT_ID, "total_orders", string_label=True),
                      key_expr=key_expr, key_inputs=tuple(key_inputs))


def _tx_count(name: str, key: str, key_expr=None, key_inputs=()) -> ReportSpec:
    return ReportSpec(name, "tx", key, (m_count("transaction_count", TX_ID),),
                      key_expr=key_expr, key_inputs=tuple(key_inputs))


AGE = (lambda: age_group("user_age"), ("user_age",))
INCOME = (lambda: income_group("user_income"), ("user_income",))
COST = (lambda: cost_group("freight_cost_usd"), ("freight_cost_usd",))

REPORTS: dict[str, ReportSpec] = {}


def _register(*specs: ReportSpec) -> None:
    for s in specs:
        REPORTS[s.name] = s


# E-commerce summary
_register(
    ReportSpec("category_analytics", "tx", "category", (
        m_avg("avg_transaction_amount", "total_amount"),
        m_count("transaction_count", TX_ID),
        m_max("max_transaction_amount", "total_amount"),
        m_min("min_transaction_amount", "total_amount"),
    )),
    _tx_count("payment_method_analytics", "payment_method"),
    _tx_count("age_group_analytics", "age_group", *AGE),
    _tx_count("city_analytics", "user_city"),
    _tx_count("device_analytics", "user_device"),
    ReportSpec("income_analytics", "tx", "user_income",
               (m_avg("avg_transaction_amount", "total_amount"),)),
    ReportSpec("fraud_analytics", "tx", "category", (fraud_percentage_sum_form(),)),
)

# E-commerce fraud rates
_register(
    _tx_fraud("fraud_category", "category"),
    _tx_fraud("fraud_payment", "payment_method"),
    _tx_fraud("fraud_device", "user_device"),
    _tx_fraud("fraud_city", "user_city"),
    _tx_fraud("fraud_age", "age_group", *AGE),
    _tx_fraud("fraud_income", "income_group", *INCOME),
)

# Supply-chain summary
_register(
    ReportSpec("product_group_analytics", "sc", "product_group", (
        m_avg("avg_line_item_value", "line_item_value"),
        m_count("total_orders", SC_ORDER_ID),
        m_max("max_line_item_value", "line_item_value"),
        m_min("min_line_item_value", "line_item_value"),
    )),
    ReportSpec("vendor_analytics", "sc", "vendor", (
        m_count("total_orders", SC_ORDER_ID),
        m_avg("avg_freight_cost", "freight_cost_usd"),
    )),
    ReportSpec("country_analytics", "sc", "country", (
        m_count("total_orders", SC_ORDER_ID),
        m_sum("total_freight_cost", "freight_cost_usd"),
        m_avg("avg_line_item_value", "line_item_value"),
    )),
    ReportSpec("shipment_mode_analytics", "sc", "shipment_mode", (
        m_count("total_orders", SC_ORDER_ID),
        m_avg("avg_weight", "weight_kilograms"),
        m_sum("total_freight_cost", "freight_cost_usd"),
    )),
    ReportSpec("freight_cost_analytics", "sc", None, (
        m_avg("avg_freight_cost", "freight_cost_usd"),
        m_max("max_freight_cost", "freight_cost_usd"),
        m_min("min_freight_cost", "freight_cost_usd"),
    )),
)

# Supply-chain fraud rates
_register(
    _sc_fraud("fraud_product_group", "product_group"),
    _sc_fraud("fraud_country", "country"),
    _sc_fraud("fraud_vendor", "vendor"),
    _sc_fraud("fraud_shipment_mode", "shipment_mode"),
    _sc_fraud("fraud_freight_cost", "cost_group", *COST),
)

# Dashboard sums (null keys dropped, all-null sum = 0)
_register(
    ReportSpec("freight_by_project", "sc", "project_code",
               (m_sum0("total_freight_cost", "freight_cost_usd"),), drop_null_keys=True),
    ReportSpec("quantity_by_product_group", "sc", "product_group",
               (m_sum0("total_quantity", "line_item_quantity"),), drop_null_keys=True),
)

# Report sets of the four report scripts, in publication order.
ECOMMERCE_FRAUD = ["fraud_category", "fraud_payment", "fraud_device",
                   "fraud_city", "fraud_age", "fraud_income"]
ECOMMERCE_SUMMARY = ["category_analytics", "payment_method_analytics",
                     "age_group_analytics", "city_analytics",
                     "device_analytics", "income_analytics", "fraud_analytics"]
SUPPLY_FRAUD = ["fraud_product_group", "fraud_country", "fraud_vendor",
                "fraud_shipment_mode", "fraud_freight_cost"]
SUPPLY_SUMMARY = ["product_group_analytics", "vendor_analytics",
                  "country_analytics", "shipment_mode_analytics",
                  "freight_cost_analytics"]
REPORT_SETS = {
    "ecommerce_fraud": ECOMMERCE_FRAUD,
    "ecommerce_summary": ECOMMERCE_SUMMARY,
    "supply_fraud": SUPPLY_FRAUD,
    "supply_summary": SUPPLY_SUMMARY,
}


def report(name: str, df: DataFrame) -> DataFrame:
    return run_report(REPORTS[name], df)


def inputs_of(names) -> list[str]:
    """Union of the record fields a set of reports reads (for narrow decode)."""
    cols: list[str] = []
    for n in names:
        cols += REPORTS[n].inputs
    return list(dict.fromkeys(cols))


def available_reports(df: DataFrame, names=None) -> list[str]:
    """Reports whose input columns all exist in ``df`` (schema only, no job):
    a view is emitted only when its columns are present."""
    have = set(df.columns)
    return [n for n in (names or REPORTS) if set(REPORTS[n].inputs) <= have]
