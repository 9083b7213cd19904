"""Row-level operators: name normalisation, keyed latest-wins, hash split,
oversampling and the empty/columns guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import hash_unit
from fraudlens.schemas import supply_aliases


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_supply(df: DataFrame, aliases: dict | None = None) -> DataFrame:
    """Rename any known spelling of a supply field to its canonical name.
    Unknown columns keep their name.  A projection only: no job."""
    table = aliases or supply_aliases()
    seen = set()
    out = []
    for c in df.columns:
        canon = table.get(c, c)
        if canon in seen:
            raise ValueError(f"two input columns map to {canon!r}")
        seen.add(canon)
        out.append(_q(c).alias(canon))
    return df.select(*out)


def conform(df: DataFrame, schema) -> DataFrame:
    """Select ``schema``'s fields in order; absent fields become typed nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def latest_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per key: the row whose ``order_cols`` struct is largest.

    ``max_by`` is an ordinary aggregate with a partial (map-side) phase, so
    a key that holds a third of all rows is reduced inside every map task
    before the shuffle.  Nulls inside the winning row are kept."""
    value_cols = [c for c in df.columns if c != key]
    return (df.groupBy(key)
              .agg(F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_row"))
              .select(key, "_row.*"))


def hash_split(df: DataFrame, key_cols, weights=(0.8, 0.2), seed: int = 42,
               name: str = "split") -> DataFrame:
    """Tag each row with its split index from a seeded hash of the key: the
    same rows land in the same split at any partitioning or re-run."""
    total = float(sum(weights))
    u = hash_unit(seed, *[F.col(c) for c in key_cols])
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    expr = None
    for i, e in enumerate(edges):
        expr = F.when(u < e, i) if expr is None else expr.when(u < e, i)
    expr = F.lit(len(weights) - 1) if expr is None else expr.otherwise(len(weights) - 1)
    return df.withColumn(name, expr.cast("int"))


def split_frames(df: DataFrame, key_cols, weights=(0.8, 0.2), seed: int = 42):
    tagged = hash_split(df, key_cols, weights, seed, "_split")
    return [tagged.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def oversample(df: DataFrame, copies: int, copy_col: str = "copy") -> DataFrame:
    """k exact copies of every row, numbered 1..k; generated inside each
    task by ``explode(sequence)``, so no join and no shuffle."""
    if copies < 1:
        raise ValueError("copies must be >= 1")
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.lit(int(copies)))))


def available(df: DataFrame, columns) -> bool:
    """Column-presence guard: schema only, runs no job."""
    return set(columns) <= set(df.columns)


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard: reads at most one row."""
    return df.isEmpty()
