"""Write PLANS.md: formatted physical plans of the headline jobs.

    python tests/plans_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plan(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    text = re.sub(r"file:/\S+/fraudlens/", "<shared>/fraudlens/", text)
    text = re.sub(r"#\d+L?", "", text)            # expression ids add noise
    return text.strip()


def main(argv) -> int:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from fraudlens.functions import fraud_probability
    from fraudlens.ml.auc import auc_frame
    from fraudlens.ml.model import LABEL, with_label
    from fraudlens.operators import dashboard, fused
    from fraudlens.operators.reports import ECOMMERCE_FRAUD, inputs_of
    from fraudlens.plans import queries as Q
    from fraudlens.session import get_session, shared_dir
    from fraudlens.sinks import keyed
    from fraudlens.sources.envelope import decode_transactions, read_batch
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    t = Q.fixture_topics(spark, sf)
    env = read_batch(spark, t, Q.TX_TOPIC, Q.BOUNDED_START, Q.BOUNDED_END)

    def keyed_lookup(spark, sf):
        path = shared_dir(spark, "plans-table")
        rows = Q.sc(spark, sf).select("pq", "country", F.lit(1).alias("v"))
        for _ in range(2):
            keyed.upsert(spark, rows, path, "pq", ["v"])
        return keyed.read_table(spark, path, ["PQ-1-1", "PQ-2-1"])

    sections = [
        ("Report script: bounded topic read -> narrow JSON decode -> six fraud reports fused",
         "Offset bounds reach the Parquet scan as PushedFilters; from_json carries only the 8 fields the "
         "set reads; Expand feeds a partial HashAggregate, so one row per (set, key, task) is shuffled; "
         "the 18 output measures come from two aggregate functions.",
         fused.fused_aggregate(decode_transactions(env, inputs_of(ECOMMERCE_FRAUD)), ECOMMERCE_FRAUD)),
        ("Record view tx (fixture): line items and orders meet in a shuffle join",
         "Dimensions are broadcast only after the bounded row-count probe; line items and orders, which "
         "both grow with the data, are joined by sort-merge on the order key; ReadSchema shows pruning.",
         Q.QUERIES["fraud_category"](spark, sf)),
        ("Dashboard: freight histogram with known bounds",
         "Bin edges enter as literals; one partial and one final aggregate.",
         dashboard.histogram(Q.sc(spark, sf), "freight_cost_usd", 20, (18.0364, 2099.9576))),
        ("Keyed table: lookup of two keys in a table of two puts",
         "The keys reach the scan of every put (PushedFilters); the rank limit runs before the exchange.",
         keyed_lookup(spark, sf)),
        ("Area under the curve of the risk score",
         "Ties collapse in the partial aggregate; ranges of scores are stored; windows per range, in the JVM.",
         auc_frame(with_label(Q.sc(spark, sf)).select(fraud_probability().alias("s"), LABEL), "s", LABEL)),
    ]
    out = ["# PLANS", "", f"Generated by `python tests/plans_report.py` on `{sf}` "
           "(expression ids removed). Regenerate after plan-affecting changes.", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", _plan(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
