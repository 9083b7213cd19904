"""Exact area under the ROC curve, distributed, in JVM expressions only.

AUC = sum over positives of (#negatives scored lower + 1/2 #negatives tied)
divided by P * N.  The plan:

1. ``groupBy(score)`` -> (score, pos, neg): partial aggregation collapses
   ties (a score held by a third of all rows is one row per map task).
2. ``repartitionByRange(score)``: the range's number is kept as a column, in a
   written table, so that every later step sees the same ranges.
3. A window per range, in score order: the running sum of negatives.  A range is
   one task's share of the distinct scores, never a group of the data.
4. One row per range: its negatives, summed over the ranges before it.  Each
   range's positives also beat those; one row per range is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import cut_lineage


def auc_frame(df: DataFrame, score: str, label: str, partitions: int | None = None) -> DataFrame:
    """One-row DataFrame ``auc`` (null when a class is absent)."""
    y = F.col(label).cast("double")
    g = (df.where(F.col(score).isNotNull() & y.isNotNull())
           .groupBy(F.col(score).cast("double").alias("score"))
           .agg(F.sum(F.when(y == 1.0, 1).otherwise(0)).alias("pos"),
                F.sum(F.when(y == 1.0, 0).otherwise(1)).alias("neg")))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(g.repartitionByRange(n, "score").withColumn("range", F.spark_partition_id()))
    below = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("neg").over(below), F.lit(0)) + 0.5 * F.col("neg")
    per_range = ranged.select("range", "pos", "neg", (F.col("pos") * lower).alias("part")).groupBy("range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("part").alias("part"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)     # one row per range
    combined = per_range.select(
        "pos", "neg",
        (F.col("part") + F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0))).alias("contrib"))
    return combined.agg(
        F.try_divide(F.sum("contrib"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def area_under_roc(df: DataFrame, score: str, label: str) -> float | None:
    return auc_frame(df, score, label).first()["auc"]
