"""Tables behind the dashboard charts, computed over the whole table.

Dashboard rules differ from the Spark reports on purpose: rows whose group
key is null are dropped, and a label share counts only non-null labels.
Only the small result ever leaves the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import cut_lineage

# Fixed value: number of bins of the freight-cost histogram.
HISTOGRAM_BINS = 20


def label_share(df: DataFrame, key: str, label: str = "fraud_label",
                values=("0", "1"), prefix: str = "pct_label_") -> DataFrame:
    """Per key, percent of each label value among the non-null labels.

    Wide form with one column per listed value (missing -> 0); keys with no
    non-null label are absent.  One aggregation with conditional counts: no
    pivot discovery job and no window."""
    lab = F.col(label).cast("string")
    n = F.count(lab)
    aggs = [(F.count(F.when(lab == F.lit(v), 1)) / n * F.lit(100)).alias(f"{prefix}{v}")
            for v in values]
    return (df.where(F.col(key).isNotNull())
              .groupBy(key)
              .agg(n.alias("_n"), *aggs)
              .where(F.col("_n") > 0)
              .drop("_n"))


def label_share_long(df: DataFrame, key: str, label: str = "fraud_label") -> DataFrame:
    """Long form for any set of label values: (key, label, share_pct).

    Raw rows are first reduced to one row per (key, label) by partial
    aggregation; the per-key denominator is then a window over those
    aggregated rows (one row per label value per key), never over raw rows."""
    pairs = (df.where(F.col(key).isNotNull() & F.col(label).isNotNull())
               .groupBy(key, label).agg(F.count(F.lit(1)).alias("_c")))
    total = F.sum("_c").over(Window.partitionBy(key))
    return pairs.select(key, F.col(label).cast("string").alias("label"),
                        (F.col("_c") / total * F.lit(100)).alias("share_pct"))


def finite(c):
    """The value, or null if it is NaN or infinite: neither has a bin."""
    x = F.col(c) if isinstance(c, str) else c
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def value_bounds(df: DataFrame, c: str) -> tuple:
    """(min, max) of a column's finite values: one small aggregate."""
    row = df.agg(F.min(finite(c)).alias("lo"), F.max(finite(c)).alias("hi")).first()
    return row["lo"], row["hi"]


def histogram(df: DataFrame, c: str, bins: int = HISTOGRAM_BINS,
              bounds: tuple | None = None) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last
    bin, a constant column puts everything in bin 0; nulls, NaN and infinite
    values are dropped.

    The bounds come from one small aggregate (two scalars) and enter the
    binning pass as literals, so the counting pass is a plain partial +
    final aggregate with no join."""
    lo, hi = bounds if bounds is not None else value_bounds(df, c)
    if lo is None:
        return (df.where(F.lit(False))
                  .select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_lo"),
                          F.lit(0.0).alias("bin_hi"), F.lit(0).cast("long").alias("count")))
    lo, hi = float(lo), float(hi)
    width, x = hi - lo, finite(c)
    b = F.lit(0) if width == 0 else F.least(
        F.floor((x - F.lit(lo)) / F.lit(width) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).select(b.alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count"))
    edge = lambda k: F.lit(lo) + F.lit(width) * k / F.lit(float(bins))
    return counts.select("bin", edge(F.col("bin")).alias("bin_lo"),
                         edge(F.col("bin") + 1).alias("bin_hi"), "count")


def value_counts(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """Non-null value counts, most frequent first (key breaks ties)."""
    return (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.desc(count_col), F.asc(key)))


def weight_vs_freight(df: DataFrame, fraction: float | None = None,
                      seed: int = 42) -> DataFrame:
    """Scatter points (weight, freight, label).  The whole table by default;
    with ``fraction`` a seeded hash sample that is the same at any
    partitioning (the sample is the feature here, not a cost cap)."""
    pts = df.select("weight_kilograms", "freight_cost_usd", "fraud_label")
    if fraction is None:
        return pts
    from fraudlens.functions import hash_unit
    return (df.where(hash_unit(seed, F.col("pq")) < F.lit(float(fraction)))
              .select("weight_kilograms", "freight_cost_usd", "fraud_label"))


def dashboard_tables(df: DataFrame, bins: int = HISTOGRAM_BINS) -> dict[str, DataFrame]:
    """All six dashboard tables.

    One grouping-sets aggregate (checkpointed, a few hundred rows) serves both
    label shares, the shipment-mode counts, the quantity sums and the freight
    bounds.  The histogram (bounds as literals) and the freight sum per
    project code (nearly unique keys) are plain aggregates of their own and
    stay lazy: whoever does not read them does not pay for them."""
    lab = F.col("fraud_label").cast("string")
    keys = ["product_group", "country", "shipment_mode"]
    agg = cut_lineage(df.select(*keys, "fraud_label", "line_item_quantity", "freight_cost_usd")
             .groupingSets([["product_group"], ["country"], ["shipment_mode"], []], *keys)
             .agg(F.grouping_id().alias("_gid"),
                  F.count(lab).alias("_n_lab"),
                  F.count(F.when(lab == "0", 1)).alias("_c0"),
                  F.count(F.when(lab == "1", 1)).alias("_c1"),
                  F.count(F.lit(1)).alias("_n"),
                  F.sum("line_item_quantity").alias("_qty"),
                  F.min(finite("freight_cost_usd")).alias("_lo"),
                  F.max(finite("freight_cost_usd")).alias("_hi")))
    gid = {k: sum(1 << (len(keys) - 1 - j) for j, o in enumerate(keys) if o != k) for k in keys}

    def slice_(k):
        return agg.where((F.col("_gid") == gid[k]) & F.col(k).isNotNull())

    def shares(k):
        return (slice_(k).where(F.col("_n_lab") > 0)
                .select(k, (F.col("_c0") / F.col("_n_lab") * F.lit(100)).alias("pct_label_0"),
                        (F.col("_c1") / F.col("_n_lab") * F.lit(100)).alias("pct_label_1")))

    out = {
        "label_share_product_group": shares("product_group"),
        "label_share_country": shares("country"),
        "shipment_mode_counts": slice_("shipment_mode").select(
            "shipment_mode", F.col("_n").alias("count")).orderBy(F.desc("count"), "shipment_mode"),
        "quantity_by_product_group": slice_("product_group").select(
            "product_group", F.coalesce(F.col("_qty"), F.lit(0)).alias("total_quantity")),
    }
    bounds = agg.where(F.col("_gid") == (1 << len(keys)) - 1).select("_lo", "_hi").first()
    out["freight_histogram"] = histogram(df, "freight_cost_usd", bins, (bounds["_lo"], bounds["_hi"]))
    out["freight_by_project"] = (df.where(F.col("project_code").isNotNull()).groupBy("project_code")
                                 .agg(F.coalesce(F.sum("freight_cost_usd"), F.lit(0.0)).alias("total_freight_cost")))
    return out
