"""Column expressions: casts, buckets, fraud flags and the risk score.

Every helper returns a ``Column`` built from built-in functions so that it
stays inside whole-stage codegen; nothing here runs Python per row.
"""

from fraudlens.functions.buckets import age_group, cost_group, income_group
from fraudlens.functions.casts import (
    encode_cell,
    parse_float_lenient,
    try_double,
    try_int_legacy,
)
from fraudlens.functions.fraud import (
    draw_label,
    fraud_probability,
    hash_unit,
    is_fraud_int,
    is_fraud_str,
)

__all__ = [
    "age_group", "cost_group", "income_group", "encode_cell",
    "parse_float_lenient", "try_double", "try_int_legacy", "draw_label",
    "fraud_probability", "hash_unit", "is_fraud_int", "is_fraud_str",
]
