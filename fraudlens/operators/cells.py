"""Rows -> cells of a wide-column store: (row_key, family, qualifier, value).

``unpivot`` is a narrow per-row expansion (no shuffle).  Cell values are
text, a null becomes the empty string (what a put of ``b''`` stores)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import encode_cell

DEFAULT_FAMILY = "cf1"


def to_cells(df: DataFrame, row_key: str, columns=None,
             family: str = DEFAULT_FAMILY) -> DataFrame:
    cols = list(columns) if columns else [c for c in df.columns if c != row_key]
    enc = df.select(F.col(row_key).cast("string").alias("row_key"),
                    *[encode_cell(c).alias(c) for c in cols])
    return (enc.unpivot(["row_key"], cols, "qualifier", "value")
               .select("row_key", F.lit(family).alias("family"), "qualifier", "value"))
