"""Fraud flags, the additive risk rule and seeded, partition-independent
random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the risk rule: base probability and increments.
BASE_FRAUD_PROBABILITY = 0.05
HIGH_FREIGHT_THRESHOLD = 1500
HIGH_FREIGHT_INCREMENT = 0.1
AIR_MODE = "Air"
AIR_INCREMENT = 0.05
RISKY_REGIONS = ["Asia", "South America"]
REGION_INCREMENT = 0.05

_UNIT_BITS = 52                  # 13 hex digits: every value is exact in a double


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_fraud_int(c="fraud_label") -> Column:
    """True when the integer label equals 1; null label -> null (not fraud)."""
    return _col(c) == F.lit(1)


def is_fraud_str(c="fraud_label") -> Column:
    """True when the string label is exactly "1" ("1.0" is not fraud)."""
    return _col(c) == F.lit("1")


def fraud_probability(
    freight="freight_cost_usd",
    mode="shipment_mode",
    region="country",
    base: float = BASE_FRAUD_PROBABILITY,
    regions=None,
) -> Column:
    """Additive risk: base + 0.1 (freight > 1500) + 0.05 (Air) + 0.05
    (risky region).  A null input adds nothing."""
    regions = RISKY_REGIONS if regions is None else list(regions)
    return (
        F.lit(float(base))
        + F.when(_col(freight) > HIGH_FREIGHT_THRESHOLD, HIGH_FREIGHT_INCREMENT).otherwise(0.0)
        + F.when(_col(mode) == AIR_MODE, AIR_INCREMENT).otherwise(0.0)
        + F.when(_col(region).isin(regions), REGION_INCREMENT).otherwise(0.0)
    )


def hash_unit(seed: int, *cols) -> Column:
    """Deterministic uniform draw in [0, 1): the first 13 hex digits of the
    md5 of "<seed>|<text of each column>" (null as the empty text) over 2^52.
    Unlike ``rand(seed)`` it does not depend on partitioning, and any engine
    with md5 repeats it."""
    parts = [F.lit(str(int(seed)))] + [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, _UNIT_BITS // 4)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << _UNIT_BITS))


def draw_label(p, seed: int, *key_cols) -> Column:
    """Bernoulli(p) label (int 1/0) drawn from a seeded hash of the key."""
    return F.when(hash_unit(seed, F.lit("label"), *key_cols) < _col(p), 1).otherwise(0)
