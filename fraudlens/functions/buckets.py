"""Bucket expressions.  A null input (or one that no branch matches) gives
null: there is deliberately no ``otherwise`` so that null keys form their
own group in the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges and labels.
AGE_BUCKETS = [(20, "Under 20"), (30, "20-29"), (40, "30-39"), (50, "40-49")]
AGE_TOP = "50+"
INCOME_BUCKETS = [
    (20000, "Under 20k"), (60000, "20k-59k"), (100000, "60k-99k"),
    (140000, "100k-139k"),
]
INCOME_TOP = "140k+"
COST_BUCKETS = [(500, "Low Cost"), (1500, "Medium Cost")]
COST_TOP = "High Cost"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bucket(c, edges, top) -> Column:
    x = _col(c)
    expr = None
    for upper, label in edges:
        expr = F.when(x < upper, label) if expr is None else expr.when(x < upper, label)
    return expr.when(x >= edges[-1][0], top)


def age_group(c="user_age") -> Column:
    return _bucket(c, AGE_BUCKETS, AGE_TOP)


def income_group(c="user_income") -> Column:
    return _bucket(c, INCOME_BUCKETS, INCOME_TOP)


def cost_group(c="freight_cost_usd") -> Column:
    return _bucket(c, COST_BUCKETS, COST_TOP)
