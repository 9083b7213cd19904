"""End-to-end jobs: source -> operators -> sink.

Each job reads its input once.  A report set is answered by one fused
grouping-sets aggregate whose (small) result is checkpointed to the shared
folder, then sliced per report and published in a single write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions import parse_float_lenient
from fraudlens.operators import fused
from fraudlens.operators.reports import REPORTS, REPORT_SETS, inputs_of, run_report
from fraudlens.operators.rows import conform, normalize_supply
from fraudlens.schemas import SUPPLY_NUMERIC_FIELDS, SUPPLY_SCHEMA
from fraudlens.sinks.keyed import upsert
from fraudlens.sinks.publish import publish_many
from fraudlens.sources.csv import read_csv
from fraudlens.sources.envelope import Transport, decode, decode_supply, decode_transactions, read_batch
from fraudlens.operators.cells import to_cells
from fraudlens.session import cut_lineage


def report_set(df: DataFrame, names, strategy: str = "fused") -> dict[str, DataFrame]:
    """Answer several reports over one input.

    ``fused``: one grouping-sets aggregate (one scan), checkpointed so that
    slicing it per report does not recompute it.  ``separate``: one
    aggregate per report (the input is read once per report unless the
    caller persisted it)."""
    names = list(names)
    if strategy == "separate":
        return {n: run_report(REPORTS[n], df) for n in names}
    fusable = [n for n in names if not REPORTS[n].drop_null_keys]
    out = {}
    if fusable:
        agg = cut_lineage(fused.fused_aggregate(df, fusable))
        out.update(fused.split_fused(agg, fusable))
    for n in names:
        if n not in out:
            out[n] = run_report(REPORTS[n], df)
    return out


def publish_reports(spark: SparkSession, records: DataFrame, names, transport: Transport,
                    strategy: str = "fused") -> dict[str, DataFrame]:
    """Compute a report set and publish each report to its topic (one write)."""
    frames = report_set(records, names, strategy)
    publish_many(spark, {REPORTS[n].output_topic: frames[n] for n in frames}, transport,
                 key_cols=report_keys(frames))
    return frames


def report_keys(names) -> dict[str, str]:
    """Output topic -> key column of each report that has one."""
    return {REPORTS[n].output_topic: REPORTS[n].key for n in names if REPORTS[n].key}


def decoder_for(family: str):
    """Envelope -> typed records of a family, decoding only ``fields``."""
    return decode_transactions if family == "tx" else decode_supply


def publish_script(spark: SparkSession, transport: Transport, source_topic: str,
                   set_name: str, sink: Transport | None = None) -> dict[str, DataFrame]:
    """One report script as one job: read the topic once, decode only the
    fields the set reads, fused aggregate, publish every report together."""
    names = REPORT_SETS[set_name]
    family = REPORTS[names[0]].family
    env = read_batch(spark, transport, source_topic)
    records = decoder_for(family)(env, inputs_of(names))
    return publish_reports(spark, records, names, sink or transport)


def ingest_csv(spark: SparkSession, path: str, transport: Transport, topic: str,
               partitions: int = 3, multi_line: bool = False) -> int:
    """The producer as one Spark job: CSV (any known header spelling) ->
    canonical record (numeric fields parsed leniently) -> JSON messages.
    Returns the number of messages, observed in the write (one scan of the CSV)."""
    raw = normalize_supply(read_csv(spark, path, multi_line=multi_line))
    typed = raw.select(*[parse_float_lenient(c).alias(c) if c in SUPPLY_NUMERIC_FIELDS
                         else F.col(c) for c in raw.columns])
    records = conform(typed, SUPPLY_SCHEMA)
    return publish_many(spark, {topic: records}, transport, partitions)


def load_keyed_store(spark: SparkSession, transport: Transport, topic: str, schema,
                     table_path: str, key: str, where=None):
    """Topic -> latest row per key in a keyed table (the HBase load).
    ``where`` limits the load to some messages (by timestamp, say); supply
    records are read in any spelling."""
    env = read_batch(spark, transport, topic)
    env = (env if where is None else env.where(where)).select(
        "value", F.col("timestamp").alias("_ts"), F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"))
    kept = ("_ts", "_partition", "_offset")
    records = decode_supply(env, keep=kept) if schema is SUPPLY_SCHEMA else decode(env, schema, keep=kept)
    return upsert(spark, records, table_path, key, ["_ts", "_partition", "_offset"])


def keyed_cells(spark: SparkSession, table_path: str, key: str, family: str = "cf1") -> DataFrame:
    from fraudlens.sinks.keyed import read_table
    t = read_table(spark, table_path)
    cols = [c for c in t.columns if c not in (key, "_ts", "_partition", "_offset")]
    return to_cells(t, key, cols, family)


def show_reports(frames: dict[str, DataFrame], n: int = 20, truncate: bool = True) -> None:
    """Print the first rows of each report (the scripts' ``show()``)."""
    for name, df in frames.items():
        print(f"== {name}")
        df.show(n, truncate)


def report_row_key(name: str, key: str | None):
    """``<report>#<key>``; a report without a key, or the group of the null
    key, is ``<report>`` alone, so that null and "" stay apart."""
    if key is None:
        return F.lit(name)
    return F.coalesce(F.concat(F.lit(name + "#"), F.col(key).cast("string")), F.lit(name))


def store_reports(spark: SparkSession, frames: dict[str, DataFrame], table_path: str):
    """Insights into the keyed store: one row per (report, key), the newest
    put wins.  Measures are kept as a JSON document per row."""
    parts = []
    for name, df in frames.items():
        spec = REPORTS[name]
        parts.append(df.select(
            report_row_key(name, spec.key).alias("row_key"), F.lit(name).alias("report"),
            F.to_json(F.struct(*[F.col(m.name) for m in spec.measures])).alias("measures")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return upsert(spark, rows, table_path, "row_key")


def generate_csv(spark: SparkSession, path: str, rows: int = 1_000_000, seed: int = 42,
                 base: float = 0.05, **kw) -> None:
    """The generator job: synthetic supply lines written as a header CSV
    with the display spellings (``Project Code``, ``Freight Cost (USD)``...)."""
    from fraudlens.schemas import DISPLAY_NAMES
    from fraudlens.sinks.files import write_csv
    from fraudlens.sources.synth import synth_supply
    df = synth_supply(spark, rows, seed, base, **kw).drop("id")
    write_csv(df.select(*[F.col(c).alias(DISPLAY_NAMES.get(c, c)) for c in df.columns]), path)
