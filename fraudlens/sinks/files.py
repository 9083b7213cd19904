"""File sinks: CSV with header (RFC 4180)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Quotes inside a field are doubled; null is an empty field, the empty
    text a quoted one."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
