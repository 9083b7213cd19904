"""Null-safe casts.

ANSI mode is on in Spark 4, where a plain ``cast`` of a bad string raises.
The records come from untrusted JSON, so a bad value must become null and
never fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: leading numeric prefix accepted by the lenient float parser
# (optional sign, digits with optional fraction or a bare fraction, optional
# exponent).  "12kg" -> 12, "abc" -> null.
LENIENT_FLOAT_PATTERN = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c) -> Column:
    """String -> double; malformed text becomes null."""
    return _col(c).try_cast("double")


def try_int_legacy(c) -> Column:
    """String -> int with the non-ANSI rules: "1.0" -> 1, "-1.9" -> -1
    (truncation), malformed text, NaN, infinity and overflow -> null."""
    return _col(c).try_cast("double").try_cast("int")


def parse_float_lenient(c) -> Column:
    """Parse the leading numeric prefix of a string; no prefix -> null."""
    prefix = F.regexp_extract(_col(c).cast("string"), LENIENT_FLOAT_PATTERN, 1)
    return F.nullif(prefix, F.lit("")).try_cast("double")


def encode_cell(c) -> Column:
    """Text of a cell value for a wide-column store: null -> empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))
