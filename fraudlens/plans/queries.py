"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables of ``sf_dir`` (through the ``tx`` and
``sc`` record views, or JSON envelopes Spark derives from them) and runs a
library operator over the whole input.  Columns whose value is a sum or
average of doubles are rounded to 4 places *here*, in the comparison layer,
because their last bits depend on summation order; the operators themselves
never round.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.operators import dashboard, fused
from fraudlens.operators.reports import REPORTS, report
from fraudlens.sources import fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Output columns that hold order-dependent double sums/averages.
ROUND_COLUMNS = {
    "avg_transaction_amount", "avg_line_item_value", "avg_freight_cost",
    "total_freight_cost", "avg_weight",
}
ROUND_PLACES = 4


def _round_step(x, places: int):
    scale = float(10 ** places)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def round_places(c, places: int = ROUND_PLACES):
    """Round in two steps, each made of single IEEE operations so Spark and
    DuckDB agree bit for bit: first snap to ``places + 4`` digits (this
    removes the last-bit noise of order-dependent sums, e.g. a mean of
    cents that is exactly ...5 at the fifth place), then round to
    ``places``.  ``round(x, p)`` itself differs between the two engines on
    values that print as an exact half."""
    return _round_step(_round_step(F.col(c), places + 4), places)


def rounded(df: DataFrame, cols=None, places: int = ROUND_PLACES) -> DataFrame:
    cols = ROUND_COLUMNS if cols is None else set(cols)
    return df.select(*[round_places(c, places).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def tx(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    return fixtures.transactions(spark, sf_dir, with_source)


def sc(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    return fixtures.supply_lines(spark, sf_dir, with_source)


VIEWS = {"tx": tx, "sc": sc}


def _report_query(name: str) -> QueryFn:
    spec = REPORTS[name]
    return lambda spark, sf_dir: rounded(report(name, VIEWS[spec.family](spark, sf_dir)))


for _name in REPORTS:
    QUERIES[_name] = _report_query(_name)


@register("fraud_all_dimensions")
def q_fraud_all_dimensions(spark, sf_dir):
    from fraudlens.operators.reports import ECOMMERCE_FRAUD
    return fused.fraud_all_dimensions(tx(spark, sf_dir), ECOMMERCE_FRAUD)


@register("supply_fraud_all_dimensions")
def q_supply_fraud_all_dimensions(spark, sf_dir):
    from fraudlens.operators.reports import SUPPLY_FRAUD
    return fused.fraud_all_dimensions(sc(spark, sf_dir), SUPPLY_FRAUD)


@register("label_share_product_group")
def q_label_share_product_group(spark, sf_dir):
    return dashboard.label_share(sc(spark, sf_dir), "product_group")


@register("label_share_country")
def q_label_share_country(spark, sf_dir):
    return dashboard.label_share(sc(spark, sf_dir), "country")


@register("label_share_country_long")
def q_label_share_country_long(spark, sf_dir):
    return dashboard.label_share_long(sc(spark, sf_dir), "country")


@register("freight_histogram")
def q_freight_histogram(spark, sf_dir):
    h = dashboard.histogram(sc(spark, sf_dir), "freight_cost_usd")
    return rounded(h, ["bin_lo", "bin_hi"], 6)


@register("shipment_mode_counts")
def q_shipment_mode_counts(spark, sf_dir):
    return dashboard.value_counts(sc(spark, sf_dir), "shipment_mode")


@register("weight_vs_freight")
def q_weight_vs_freight(spark, sf_dir):
    return dashboard.weight_vs_freight(sc(spark, sf_dir))


@register("age_group")
def q_age_group(spark, sf_dir):
    from fraudlens.functions import age_group
    return tx(spark, sf_dir).groupBy(F.col("user_age")).agg(
        F.count(F.lit(1)).alias("n")).select(
        "user_age", age_group("user_age").alias("age_group"), "n")


@register("income_group")
def q_income_group(spark, sf_dir):
    from fraudlens.functions import income_group
    return tx(spark, sf_dir).groupBy(F.col("user_income")).agg(
        F.count(F.lit(1)).alias("n")).select(
        "user_income", income_group("user_income").alias("income_group"), "n")


@register("cost_group")
def q_cost_group(spark, sf_dir):
    from fraudlens.functions import cost_group
    return sc(spark, sf_dir).select(
        "pq", "freight_cost_usd", cost_group("freight_cost_usd").alias("cost_group"))


@register("fraud_probability")
def q_fraud_probability(spark, sf_dir):
    from fraudlens.functions import fraud_probability
    p = fraud_probability(regions=["ASIA", "AMERICA"])
    return (sc(spark, sf_dir).select("country", p.alias("fraud_probability"))
            .groupBy("country", "fraud_probability")
            .agg(F.count(F.lit(1)).alias("line_count")))


# ---------------------------------------------------------------------------
# Sources, payload codecs, casts and sinks.  A topic is written once per
# process and data folder under the shared checkpoint location, when a query
# first reads it.
# ---------------------------------------------------------------------------

_TOPICS: dict[tuple, object] = {}
TX_TOPIC, SC_TOPIC = "transactions", "supply_chain_data"

# Offset bounds used by the bounded-read query (fixed values).
BOUNDED_START = {TX_TOPIC: {"0": -2, "1": 1 << 58, "2": -2}}
BOUNDED_END = {TX_TOPIC: {"0": 3 << 58, "1": -1, "2": -1}}


def fixture_topics(spark: SparkSession, sf_dir: str, *topics: str):
    """File transport holding the ``tx`` and ``sc`` envelopes of ``sf_dir``, or
    those of the named topics (and of others that were asked for before)."""
    from fraudlens.session import shared_dir
    from fraudlens.sinks.publish import write_envelopes
    from fraudlens.sources.envelope import files
    key = (id(spark), sf_dir)
    t, written = _TOPICS.setdefault(key, (files(shared_dir(spark, "topics")), set()))
    envelopes = {TX_TOPIC: fixtures.transaction_envelope, SC_TOPIC: fixtures.supply_envelope}
    for topic in topics or envelopes:
        if topic not in written:
            write_envelopes(spark, envelopes[topic](spark, sf_dir, topic), t, "overwrite", topic)
            written.add(topic)
    return t


def _tx_records(spark, sf_dir, fields=None, keep=()):
    from fraudlens.sources.envelope import decode_transactions, read_batch
    env = read_batch(spark, fixture_topics(spark, sf_dir, TX_TOPIC), TX_TOPIC)
    return decode_transactions(env, fields, keep)


@register("src_envelope_batch")
def q_src_envelope_batch(spark, sf_dir):
    from fraudlens.sources.envelope import decode_transactions, read_batch
    env = read_batch(spark, fixture_topics(spark, sf_dir, TX_TOPIC), TX_TOPIC,
                     BOUNDED_START, BOUNDED_END)
    rec = decode_transactions(env, ["transaction_id", "fraud_label"], keep=("partition",))
    return rec.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count("transaction_id").alias("with_id"),
        F.count(F.when(F.col("fraud_label") == 1, 1)).alias("fraud_count"))


@register("decode_transactions")
def q_decode_transactions(spark, sf_dir):
    from fraudlens.schemas import TRANSACTION_FIELDS
    return _tx_records(spark, sf_dir).select(*TRANSACTION_FIELDS)


@register("decode_narrow_fraud_category")
def q_decode_narrow_fraud_category(spark, sf_dir):
    from fraudlens.operators.reports import inputs_of
    rec = _tx_records(spark, sf_dir, inputs_of(["fraud_category"]))
    return report("fraud_category", rec)


@register("audit_count")
def q_audit_count(spark, sf_dir):
    rec = _tx_records(spark, sf_dir, ["transaction_id"])
    return rec.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count("transaction_id").alias("rows_with_id"))


@register("preview_100")
def q_preview_100(spark, sf_dir):
    from fraudlens.sources.envelope import decode_transactions, preview, read_batch
    env = read_batch(spark, fixture_topics(spark, sf_dir, TX_TOPIC), TX_TOPIC)
    top = preview(env, 100)
    return decode_transactions(top, ["transaction_id", "category", "total_amount"],
                               keep=("partition", "offset"))


@register("cast_transactions")
def q_cast_transactions(spark, sf_dir):
    """The six casts over text made from the whole ``tx`` table: exact
    numbers, fractional ints, junk, overflow and signed fractions."""
    from fraudlens.sources.envelope import cast_transactions
    t = tx(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    text = t.select(
        "transaction_id",
        s("price").alias("price"),
        F.concat(s("quantity"), F.lit(".7")).alias("quantity"),
        s("total_amount").alias("total_amount"),
        F.when(F.col("user_age") % 10 == 0, F.lit("abc")).otherwise(s("user_age")).alias("user_age"),
        (F.col("user_income").cast("long") * 100000).cast("string").alias("user_income"),
        F.concat(F.lit("-"), s("fraud_label"), F.lit(".9")).alias("fraud_label"),
    )
    return cast_transactions(text)


@register("parse_float_lenient")
def q_parse_float_lenient(spark, sf_dir):
    from fraudlens.functions import parse_float_lenient
    li = fixtures.table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int").cast("string")
    m = F.col("l_linenumber") % 4
    raw = (F.when(m == 0, F.concat(q, F.lit("kg")))
            .when(m == 1, F.concat(F.lit(" -"), q, F.lit("e2x")))
            .when(m == 2, F.col("l_returnflag"))
            .otherwise(F.concat(F.lit("."), F.col("l_linenumber").cast("string"))))
    return li.select(raw.alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n")).select(
        "raw", parse_float_lenient("raw").alias("parsed"), "n")


@register("normalize_supply")
def q_normalize_supply(spark, sf_dir):
    """Supply lines renamed to the prefixed, spaced spelling and back."""
    from fraudlens.operators.rows import normalize_supply
    from fraudlens.schemas import DISPLAY_NAMES, FAMILY_PREFIX
    cols = ["project_code", "pq", "country", "vendor", "product_group",
            "shipment_mode", "freight_cost_usd", "fraud_label"]
    t = sc(spark, sf_dir).select(*cols)
    spelled = t.select(*[F.col(c).alias(FAMILY_PREFIX + DISPLAY_NAMES[c]) for c in cols])
    return normalize_supply(spelled)


@register("encode_roundtrip")
def q_encode_roundtrip(spark, sf_dir):
    """Report -> JSON messages -> decoded with the report's schema."""
    from fraudlens.sources.envelope import decode, encode
    rep = report("fraud_category", tx(spark, sf_dir))
    return decode(encode(rep), rep.schema)


@register("wide_cells")
def q_wide_cells(spark, sf_dir):
    from fraudlens.operators.cells import to_cells
    return to_cells(sc(spark, sf_dir), "pq",
                    ["country", "product_group", "fraud_label", "vendor"])


@register("publish_readback")
def q_publish_readback(spark, sf_dir):
    """Six fraud reports published to six topics in one write, read back."""
    from fraudlens.operators.reports import ECOMMERCE_FRAUD
    from fraudlens.plans.jobs import publish_reports
    from fraudlens.session import shared_dir
    from fraudlens.sources.envelope import files, read_batch
    t = files(shared_dir(spark, "reports"))
    publish_reports(spark, tx(spark, sf_dir), ECOMMERCE_FRAUD, t)
    parts = []
    for name in ECOMMERCE_FRAUD:
        spec = REPORTS[name]
        v = F.col("value").cast("string")
        parts.append(read_batch(spark, t, spec.output_topic).select(
            F.col("topic"),
            F.get_json_object(v, f"$.{spec.key}").alias("key_value"),
            F.get_json_object(v, "$.fraud_count").cast("long").alias("fraud_count"),
            F.get_json_object(v, "$.total_transactions").cast("long").alias("total_transactions"),
            F.get_json_object(v, "$.fraud_percentage").cast("double").alias("fraud_percentage")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("wide_upsert")
def q_wide_upsert(spark, sf_dir):
    """The whole supply topic loaded into a keyed table (the HBase load):
    key = purchase quote, all other 30 fields, latest (time, partition,
    offset) wins; loaded in two batches, split at the median ship date."""
    from fraudlens.plans.jobs import load_keyed_store
    from fraudlens.schemas import SUPPLY_FIELDS, SUPPLY_SCHEMA
    from fraudlens.session import shared_dir
    from fraudlens.sinks.keyed import read_table
    path = shared_dir(spark, "keyed-table")
    topics = fixture_topics(spark, sf_dir, SC_TOPIC)
    cut = F.lit("1998-06-02").cast("timestamp")
    load_keyed_store(spark, topics, SC_TOPIC, SUPPLY_SCHEMA, path, "pq",
                     where=F.col("timestamp") < cut)
    load_keyed_store(spark, topics, SC_TOPIC, SUPPLY_SCHEMA, path, "pq",
                     where=F.col("timestamp") >= cut)
    return read_table(spark, path).select(*SUPPLY_FIELDS, "_partition", "_offset")


@register("decode_supply_spelled")
def q_decode_supply_spelled(spark, sf_dir):
    """All supply lines as messages, each in one of five spellings (plain,
    spaced, underscored, and the latter two under the family prefix), some
    with their numbers as text, decoded to the 31 canonical fields."""
    from fraudlens.schemas import DISPLAY_NAMES, FAMILY_PREFIX, SUPPLY_FIELDS, SUPPLY_NUMERIC_FIELDS
    from fraudlens.sources.envelope import decode_supply
    named = [lambda c: c, lambda c: DISPLAY_NAMES[c], lambda c: DISPLAY_NAMES[c].replace(" ", "_"),
             lambda c: FAMILY_PREFIX + DISPLAY_NAMES[c], lambda c: FAMILY_PREFIX + DISPLAY_NAMES[c].replace(" ", "_")]

    def message(k):
        text = k >= 3                              # cells of a wide-column store are text
        return F.to_json(F.struct(*[(F.col(c).cast("string") if text and c in SUPPLY_NUMERIC_FIELDS else F.col(c))
                                    .alias(named[k](c)) for c in SUPPLY_FIELDS]))
    lines = sc(spark, sf_dir, with_source=True)
    spelling = F.col("l_linenumber") % 5
    value = message(4)
    for k in range(4):
        value = F.when(spelling == k, message(k)).otherwise(value)
    env = lines.select(spelling.alias("spelling"), value.cast("binary").alias("value"))
    return decode_supply(env, keep=("spelling",))


@register("ingest_csv")
def q_ingest_csv(spark, sf_dir):
    """Supply lines written as a generator-style CSV (spaced headers), then
    ingested: CSV -> canonical record -> topic; read back and decoded."""
    from fraudlens.plans.jobs import ingest_csv
    from fraudlens.schemas import DISPLAY_NAMES, SUPPLY_SCHEMA
    from fraudlens.session import shared_dir
    from fraudlens.sinks.files import write_csv
    from fraudlens.sources.envelope import decode, files, read_batch
    cols = ["project_code", "pq", "country", "vendor", "product_group", "shipment_mode",
            "line_item_quantity", "weight_kilograms", "freight_cost_usd", "fraud_label"]
    csv_dir = shared_dir(spark, "csv")
    write_csv(sc(spark, sf_dir).select(*[F.col(c).alias(DISPLAY_NAMES[c]) for c in cols]), csv_dir)
    t = files(shared_dir(spark, "ingest"))
    ingest_csv(spark, csv_dir, t, "supply_chain_transactions")
    rec = decode(read_batch(spark, t, "supply_chain_transactions"), SUPPLY_SCHEMA, cols)
    return rec


@register("oversample")
def q_oversample(spark, sf_dir):
    from fraudlens.operators.rows import oversample
    from fraudlens.plans.joins import spread_by
    return (oversample(spread_by(sc(spark, sf_dir).select("pq", "country"), "pq"), 3)
            .groupBy("country", "copy").agg(F.count(F.lit(1)).alias("n"),
                                            F.count_distinct("pq").alias("distinct_pq")))


# ---------------------------------------------------------------------------
# Streaming: the fixture topic replayed as a file stream, a few files per
# micro-batch, into a sink in the shared folder; the sink is read back.
# ---------------------------------------------------------------------------

STREAM_FILES_PER_TRIGGER = 4


def _tx_stream(spark, sf_dir):
    from fraudlens.sources.envelope import read_stream
    return read_stream(spark, fixture_topics(spark, sf_dir, TX_TOPIC), TX_TOPIC,
                       max_per_trigger=STREAM_FILES_PER_TRIGGER)


def stream_raw(spark, sf_dir):
    from fraudlens.session import shared_dir
    from fraudlens.streaming import stream as st
    out = shared_dir(spark, "stream-raw-out")
    q = st.to_files(st.raw_values(_tx_stream(spark, sf_dir)), out, st.checkpoint_dir(spark, "raw"))
    st.run_to_end(q)
    return spark.read.parquet(out)


@register("stream_raw")
def q_stream_raw(spark, sf_dir):
    """Raw messages of the stream: their position, and three fields cut from
    the text (the JSON text itself is Spark's and no other engine's)."""
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return stream_raw(spark, sf_dir).select("topic", "partition", "offset", field("transaction_id"),
                                            field("category"), field("fraud_label"))


@register("stream_decode")
def q_stream_decode(spark, sf_dir):
    from fraudlens.schemas import TRANSACTION_FIELDS
    from fraudlens.session import shared_dir
    from fraudlens.sources.envelope import decode_transactions
    from fraudlens.streaming import stream as st
    out = shared_dir(spark, "stream-decode-out")
    q = st.to_files(decode_transactions(_tx_stream(spark, sf_dir)), out,
                    st.checkpoint_dir(spark, "decode"))
    st.run_to_end(q)
    return spark.read.parquet(out).select(*TRANSACTION_FIELDS)


@register("stream_fraud_category")
def q_stream_fraud_category(spark, sf_dir):
    from fraudlens.operators.reports import inputs_of
    from fraudlens.session import shared_dir
    from fraudlens.sources.envelope import decode_transactions
    from fraudlens.streaming import stream as st
    out = shared_dir(spark, "stream-report-out")
    rec = decode_transactions(_tx_stream(spark, sf_dir), inputs_of(["fraud_category"]))
    q = st.to_table_snapshot(st.running_report(rec, "fraud_category"), out,
                             st.checkpoint_dir(spark, "report"))
    st.run_to_end(q)
    return spark.read.parquet(out)


@register("stream_fraud_fan_out")
def q_stream_fraud_fan_out(spark, sf_dir):
    """All six e-commerce fraud reports from one stateful stream, published
    to their topics by foreachBatch after every micro-batch."""
    from fraudlens.operators.reports import ECOMMERCE_FRAUD, inputs_of
    from fraudlens.session import shared_dir
    from fraudlens.sinks.publish import publish_many
    from fraudlens.plans.jobs import report_keys
    from fraudlens.sources.envelope import compacted, decode_transactions, files, read_batch
    from fraudlens.streaming import stream as st
    t = files(shared_dir(spark, "stream-topics"))
    rec = decode_transactions(_tx_stream(spark, sf_dir), inputs_of(ECOMMERCE_FRAUD))

    def sink(epoch, frames):
        publish_many(spark, {REPORTS[n].output_topic: df for n, df in frames.items()}, t,
                     key_cols=report_keys(frames))

    st.run_to_end(st.fan_out(rec, ECOMMERCE_FRAUD, sink, st.checkpoint_dir(spark, "fan-out")))
    # The newest message per topic and key is the current report row.
    parts = []
    for name in ECOMMERCE_FRAUD:
        spec = REPORTS[name]
        v = F.col("value").cast("string")
        env = read_batch(spark, t, spec.output_topic)
        latest = compacted(env, F.get_json_object(v, f"$.{spec.key}"))
        parts.append(latest.select(
            F.lit(spec.output_topic).alias("topic"),
            F.get_json_object(v, f"$.{spec.key}").alias("key_value"),
            F.get_json_object(v, "$.fraud_count").cast("long").alias("fraud_count"),
            F.get_json_object(v, "$.total_transactions").cast("long").alias("total_transactions"),
            F.get_json_object(v, "$.fraud_percentage").cast("double").alias("fraud_percentage")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Machine learning
# ---------------------------------------------------------------------------

@register("index_shipment_mode")
def q_index_shipment_mode(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer
    data = sc(spark, sf_dir).select("shipment_mode")
    model = StringIndexer(inputCol="shipment_mode", outputCol="shipment_mode_index",
                          handleInvalid="keep").fit(data)
    return model.transform(data).groupBy("shipment_mode", "shipment_mode_index").agg(
        F.count(F.lit(1)).alias("n"))


@register("auc_fraud_probability")
def q_auc_fraud_probability(spark, sf_dir):
    """AUC of the additive risk score against the label (null label = 0)."""
    from fraudlens.functions import fraud_probability
    from fraudlens.ml.auc import auc_frame
    from fraudlens.ml.model import LABEL, with_label
    scored = with_label(sc(spark, sf_dir)).select(
        fraud_probability(regions=["ASIA", "AMERICA"]).alias("score"), LABEL)
    return rounded(auc_frame(scored, "score", LABEL), ["auc"], 10)


@register("score_transactions")
def q_score_transactions(spark, sf_dir):
    """Train on the 80% hash split of the supply lines, score the rest."""
    from fraudlens.ml.model import train_and_score
    _, pred = train_and_score(sc(spark, sf_dir))
    return pred.select("pq", "label", "fraud_score", "prediction")


@register("score_transactions_rows")
def q_score_transactions_rows(spark, sf_dir):
    """What holds for any model: the scored rows are the test split with its
    labels, scores are probabilities, predictions their rounding."""
    p = F.col("fraud_score")
    return q_score_transactions(spark, sf_dir).select(
        "pq", "label", p.between(0.0, 1.0).alias("in_range"),
        (F.col("prediction") == F.when(p > 0.5, 1.0).otherwise(0.0)).alias("consistent"))


@register("index_all_columns")
def q_index_all_columns(spark, sf_dir):
    """The indexer of the fraud model over its 13 categorical fields."""
    from fraudlens.ml.model import build_pipeline
    from fraudlens.schemas import ML_CATEGORICAL_FIELDS
    data = sc(spark, sf_dir).select(*ML_CATEGORICAL_FIELDS)
    indexed = build_pipeline().getStages()[0].fit(data).transform(data)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value"),
                                         F.col(f"{c}_index").alias("idx")) for c in ML_CATEGORICAL_FIELDS]))
    return indexed.select(cells.alias("c")).select("c.*").groupBy("field", "value", "idx").agg(
        F.count(F.lit(1)).alias("n"))


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    from fraudlens.operators.rows import hash_split
    return hash_split(sc(spark, sf_dir).select("pq", "country"), ["pq"]).groupBy(
        "split", "country").agg(F.count(F.lit(1)).alias("n"))


@register("report_store")
def q_report_store(spark, sf_dir):
    """The six fraud reports stored in the keyed table twice (a rerun must
    not duplicate rows) and read back; the category is null in some lines
    and empty in others, and the two groups must stay apart."""
    from fraudlens.operators.reports import ECOMMERCE_FRAUD
    from fraudlens.plans.jobs import report_set, store_reports
    from fraudlens.session import shared_dir
    from fraudlens.sinks.keyed import read_table
    path = shared_dir(spark, "report-store")
    blank = F.when(F.col("category").isNotNull() & (F.col("user_device") == "Tablet"), "")
    frames = report_set(tx(spark, sf_dir).withColumn("category", blank.otherwise(F.col("category"))),
                        ECOMMERCE_FRAUD)
    store_reports(spark, frames, path)
    store_reports(spark, frames, path)
    m = F.col("measures")
    return read_table(spark, path).select(
        "row_key", "report",
        F.get_json_object(m, "$.fraud_count").cast("long").alias("fraud_count"),
        F.get_json_object(m, "$.total_transactions").cast("long").alias("total_transactions"),
        F.get_json_object(m, "$.fraud_percentage").cast("double").alias("fraud_percentage"))


DASHBOARD = ("label_share_product_group", "label_share_country", "shipment_mode_counts",
             "quantity_by_product_group", "freight_by_project", "freight_histogram")


def _dashboard_query(name: str) -> QueryFn:
    def query(spark, sf_dir):
        frame = dashboard.dashboard_tables(sc(spark, sf_dir))[name]
        return rounded(frame, ["bin_lo", "bin_hi"], 6) if name == "freight_histogram" else rounded(frame)
    return query


for _name in DASHBOARD:
    QUERIES[f"dashboard_{_name}"] = _dashboard_query(_name)


def _fused_query(set_name: str) -> QueryFn:
    """A whole report set through the fused aggregate, its reports stacked:
    report, key as text, every measure of the set (null where a report has
    none of that name)."""
    from fraudlens.operators.reports import REPORT_SETS

    def query(spark, sf_dir):
        from fraudlens.plans.jobs import report_set
        names = REPORT_SETS[set_name]
        frames = report_set(VIEWS[REPORTS[names[0]].family](spark, sf_dir), names)
        out = None
        for n, df in frames.items():
            key = F.col(REPORTS[n].key).cast("string") if REPORTS[n].key else F.lit(None).cast("string")
            part = rounded(df).select(F.lit(n).alias("report"), key.alias("key_value"),
                                      *[c for c in df.columns if c != REPORTS[n].key])
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out
    return query


QUERIES["ecommerce_summary_fused"] = _fused_query("ecommerce_summary")
QUERIES["supply_summary_fused"] = _fused_query("supply_summary")


@register("publish_script_spelled")
def q_publish_script_spelled(spark, sf_dir):
    """The supply fraud script over a topic whose records carry the
    wide-column spelling (``cf1:`` and display names): read, decoded, reported,
    published and read back."""
    from fraudlens.operators.reports import SUPPLY_FRAUD
    from fraudlens.plans.jobs import publish_script
    from fraudlens.schemas import DISPLAY_NAMES, FAMILY_PREFIX, SUPPLY_FIELDS
    from fraudlens.session import shared_dir
    from fraudlens.sinks.publish import publish
    from fraudlens.sources.envelope import files, read_batch
    t = files(shared_dir(spark, "spelled"))
    lines = sc(spark, sf_dir).select(*[F.col(c).alias(FAMILY_PREFIX + DISPLAY_NAMES[c]) for c in SUPPLY_FIELDS])
    publish(spark, lines, t, SC_TOPIC)
    publish_script(spark, t, SC_TOPIC, "supply_fraud")
    out = None
    for name in SUPPLY_FRAUD:
        spec, v = REPORTS[name], F.col("value").cast("string")
        part = read_batch(spark, t, spec.output_topic).select(
            F.lit(name).alias("report"), F.get_json_object(v, f"$.{spec.key}").alias("key_value"),
            F.get_json_object(v, "$.fraud_count").cast("long").alias("fraud_count"),
            F.get_json_object(v, "$.total_orders").cast("long").alias("total_orders"),
            F.get_json_object(v, "$.fraud_percentage").cast("double").alias("fraud_percentage"))
        out = part if out is None else out.unionByName(part)
    return out


@register("stream_income_analytics")
def q_stream_income_analytics(spark, sf_dir):
    """A report with an open key domain as a stream: update mode, upserted
    per micro-batch; the table then equals the batch report."""
    from fraudlens.operators.reports import inputs_of
    from fraudlens.session import shared_dir
    from fraudlens.sinks.keyed import read_table
    from fraudlens.sources.envelope import decode_transactions
    from fraudlens.streaming import stream as st
    table = shared_dir(spark, "stream-income-table")
    rec = decode_transactions(_tx_stream(spark, sf_dir), inputs_of(["income_analytics"]))
    st.run_to_end(st.to_keyed_table(st.running_report(rec, "income_analytics"), "income_analytics", table,
                                    st.checkpoint_dir(spark, "income")))
    return rounded(read_table(spark, table).drop("_row_key"))


@register("stream_fraud_category_updates")
def q_stream_fraud_category_updates(spark, sf_dir):
    """Running fraud-by-category in update mode, upserted per micro-batch
    into the keyed table; the table then equals the batch report."""
    from fraudlens.operators.reports import inputs_of
    from fraudlens.session import shared_dir
    from fraudlens.sinks.keyed import read_table
    from fraudlens.sources.envelope import decode_transactions
    from fraudlens.streaming import stream as st
    table = shared_dir(spark, "stream-updates-table")
    rec = decode_transactions(_tx_stream(spark, sf_dir), inputs_of(["fraud_category"]))
    q = st.to_keyed_table(st.running_report(rec, "fraud_category"), "fraud_category", table,
                          st.checkpoint_dir(spark, "updates"))
    st.run_to_end(q)
    return read_table(spark, table).drop("_row_key")


@register("draw_label")
def q_draw_label(spark, sf_dir):
    """Seeded Bernoulli labels from the risk rule over every supply line:
    drawn rate per (region, probability) stratum."""
    from fraudlens.functions import draw_label, fraud_probability
    p = fraud_probability(regions=["ASIA", "AMERICA"])
    t = sc(spark, sf_dir).select("pq", "country", p.alias("p"))
    return (t.select("country", "p", draw_label(F.col("p"), 42, F.col("pq")).alias("y"))
             .groupBy("country", "p").agg(F.count(F.lit(1)).alias("n"),
                                          F.avg("y").alias("drawn_rate")))


@register("weight_vs_freight_sample")
def q_weight_vs_freight_sample(spark, sf_dir):
    """Scatter points with a seeded 10 % hash sample (the sample is the
    feature; identical at any partitioning)."""
    return dashboard.weight_vs_freight(sc(spark, sf_dir), fraction=0.1, seed=42)


# ---------------------------------------------------------------------------
# Stream control, observed counts, file round trips, and the model's parts
# ---------------------------------------------------------------------------

HALF = 1 << 59                   # fixture offsets are spread over [0, 2^60)
FILE_RECORDS, TRIGGER_RECORDS = 1000, 4000
READERS = 10                     # queries that share a rate limited topic
REWRITE_BATCHES = 100            # of one such query, between two rewrites of its log of files


def _halves(spark, sf_dir):
    env = fixtures.transaction_envelope(spark, sf_dir, TX_TOPIC)
    return env.where(F.col("offset") < HALF), env.where(F.col("offset") >= HALF)


def _to_end(df, out, checkpoint):
    from fraudlens.streaming import stream as st
    q = st.to_files(df, out, checkpoint)
    st.run_to_end(q)
    return q


@register("stream_rate_limited")
def q_stream_rate_limited(spark, sf_dir):
    """The whole topic in micro-batches of at most ``TRIGGER_RECORDS`` records:
    its rows, and what the queries reported about their batches.  The time of
    such a small batch is its logs, which wait and do not compute, so
    ``READERS`` queries read disjoint shares of the files at the same time; a
    batch is one task."""
    from functools import reduce

    from fraudlens.session import shared_dir
    from fraudlens.sinks.publish import write_envelopes
    from fraudlens.sources.envelope import decode_transactions, files, read_shares
    from fraudlens.streaming import stream as st
    t = files(shared_dir(spark, "limited-topic"), records_per_file=FILE_RECORDS)
    write_envelopes(spark, fixtures.transaction_envelope(spark, sf_dir, TX_TOPIC), t, "append", TX_TOPIC)
    running = {}
    with st.light_logs(spark, t.root, rewrite_every=REWRITE_BATCHES):
        for k, env in enumerate(read_shares(spark, t, TX_TOPIC, READERS, max_per_trigger=TRIGGER_RECORDS)):
            rec = decode_transactions(env, ["transaction_id", "fraud_label"]).coalesce(1)
            out = shared_dir(spark, f"limited-out-{k}")
            running[out] = st.to_files(rec, out, st.checkpoint_dir(spark, f"limited-{k}"))
        st.run_all_to_end(running.values())
    sizes = [n for q in running.values() for n in st.batch_sizes(q)]
    parts = [spark.read.schema(rec.schema).parquet(out) for out in running]    # each by its sink's own log
    return reduce(DataFrame.unionByName, parts).select(
        "transaction_id", "fraud_label", F.lit(max(sizes) <= TRIGGER_RECORDS).alias("bounded"),
        F.lit(len(sizes) > 1).alias("several"))


@register("stream_restart")
def q_stream_restart(spark, sf_dir):
    """A stream that ends, gets new files and starts again from its
    checkpoint: every message once."""
    from fraudlens.session import shared_dir
    from fraudlens.sinks.publish import write_envelopes
    from fraudlens.sources.envelope import decode_transactions, files, read_stream
    from fraudlens.streaming import stream as st
    t, out, checkpoint = files(shared_dir(spark, "restart-topic")), shared_dir(spark, "restart-out"), \
        st.checkpoint_dir(spark, "restart")
    for part in _halves(spark, sf_dir):
        write_envelopes(spark, part, t, "append", TX_TOPIC)
        rec = decode_transactions(read_stream(spark, t, TX_TOPIC), ["transaction_id", "category", "fraud_label"])
        _to_end(rec, out, checkpoint)
    return spark.read.parquet(out)


@register("stream_from_latest")
def q_stream_from_latest(spark, sf_dir):
    """A stream that starts at the topic's end: only what is published after
    its first start, also when it is started again."""
    from fraudlens.session import shared_dir
    from fraudlens.sinks.publish import write_envelopes
    from fraudlens.sources.envelope import decode_transactions, files, read_stream
    from fraudlens.streaming import stream as st
    t, out, checkpoint = files(shared_dir(spark, "latest-topic")), shared_dir(spark, "latest-out"), \
        st.checkpoint_dir(spark, "latest")
    for part in _halves(spark, sf_dir):
        write_envelopes(spark, part, t, "append", TX_TOPIC)
        env = read_stream(spark, t, TX_TOPIC, starting="latest", checkpoint=checkpoint)
        _to_end(decode_transactions(env, ["transaction_id", "category", "fraud_label"]), out, checkpoint)
    return spark.read.parquet(out)


@register("stream_publish_complete")
def q_stream_publish_complete(spark, sf_dir):
    """Running fraud-by-category published to its topic after every
    micro-batch (complete mode); the newest message per key is the report."""
    from fraudlens.operators.reports import inputs_of
    from fraudlens.session import shared_dir
    from fraudlens.sources.envelope import compacted, decode, decode_transactions, files, read_batch
    from fraudlens.streaming import stream as st
    spec, t = REPORTS["fraud_category"], files(shared_dir(spark, "complete-topic"))
    running = st.running_report(decode_transactions(_tx_stream(spark, sf_dir), inputs_of([spec.name])), spec)
    st.run_to_end(st.to_topic(running, t, spec.output_topic, st.checkpoint_dir(spark, "complete"), "complete",
                              key_col=spec.key))
    env = read_batch(spark, t, spec.output_topic)
    return decode(compacted(env, F.col("key")), running.schema)


@register("stream_observed_counts")
def q_stream_observed_counts(spark, sf_dir):
    """The audit counts of the whole topic, observed while a stream writes it."""
    from fraudlens.session import shared_dir
    from fraudlens.sources.envelope import decode_transactions
    from fraudlens.streaming import stream as st
    rec = st.counted(decode_transactions(_tx_stream(spark, sf_dir), ["transaction_id"]), "audit",
                     rows_with_id="transaction_id")
    q = _to_end(rec, shared_dir(spark, "observed-out"), st.checkpoint_dir(spark, "observed"))
    totals = st.observed_totals(q, "audit")
    return spark.createDataFrame([(totals["rows"], totals["rows_with_id"])], "total_rows long, rows_with_id long")


@register("ingest_csv_count")
def q_ingest_csv_count(spark, sf_dir):
    """Messages as the ingest's own write observed them, and as read back."""
    from fraudlens.plans.jobs import ingest_csv
    from fraudlens.schemas import DISPLAY_NAMES
    from fraudlens.session import shared_dir
    from fraudlens.sinks.files import write_csv
    from fraudlens.sources.envelope import files, read_batch
    path, t = shared_dir(spark, "csv"), files(shared_dir(spark, "ingest"))
    write_csv(sc(spark, sf_dir).select(*[F.col(c).alias(DISPLAY_NAMES[c]) for c in ("project_code", "pq", "vendor")]),
              path)
    written = ingest_csv(spark, path, t, "supply_chain_transactions")
    return read_batch(spark, t, "supply_chain_transactions").agg(
        F.lit(written).cast("long").alias("observed"), F.count(F.lit(1)).alias("read_back"))


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Texts with quotes, commas, backslashes, empty and missing values,
    written as CSV and read back."""
    from fraudlens.session import shared_dir
    from fraudlens.sinks.files import write_csv
    from fraudlens.sources.csv import read_csv
    path = shared_dir(spark, "csv-roundtrip")
    rest = F.col("user_age") % 3
    write_csv(tx(spark, sf_dir).select(
        "transaction_id", F.concat(F.lit('said "'), "category", F.lit('", '), "user_city").alias("quoted"),
        F.concat(F.lit("\\"), "user_device", F.lit("\\")).alias("slashed"),
        F.when(rest == 0, "").when(rest == 1, ',"').alias("odd")), path)
    odd = F.col("odd")
    return read_csv(spark, path).withColumn("odd", F.when(odd.isNull(), "missing").when(odd == "", "empty").otherwise(odd))


@register("feature_cells")
def q_feature_cells(spark, sf_dir):
    """The assembled feature vectors of all supply lines in long form: how
    often each feature has each value (imputed numbers, category indices)."""
    from fraudlens.ml.model import feature_cells
    return rounded(feature_cells(sc(spark, sf_dir)), ["value"], 6).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))


GRADIENT_TOLERANCE = 1e-5


@register("lr_gradient")
def q_lr_gradient(spark, sf_dir):
    """Whether a converged regression is the optimum of its own loss: the
    gradient at its coefficients, computed in SQL over all labelled lines."""
    from pyspark.ml.classification import LogisticRegression

    from fraudlens.ml.model import LABEL, feature_frame, labelled_or_null, logistic_gradient
    from fraudlens.schemas import ML_CATEGORICAL_FIELDS, ML_NUMERIC_FIELDS
    from fraudlens.session import cut_lineage
    rows = labelled_or_null(sc(spark, sf_dir)).where(F.col(LABEL).isNotNull()).select(
        *ML_CATEGORICAL_FIELDS, *ML_NUMERIC_FIELDS, LABEL)
    frame, names = feature_frame(rows)
    data = cut_lineage(frame.select("features", LABEL))
    fitted = LogisticRegression(labelCol=LABEL, regParam=0.01, maxIter=500, tol=1e-12).fit(data)
    found = logistic_gradient(data, names, fitted.coefficients.toArray().tolist(), fitted.intercept, 0.01)
    return found.select("feature", (F.abs("gradient") < GRADIENT_TOLERANCE).alias("optimal"))


@register("model_reload")
def q_model_reload(spark, sf_dir):
    """The fraud model fitted, saved, loaded and scored again: how many test
    rows, and how many of them get another score."""
    from fraudlens.ml.model import LABEL, load, save, score, train_and_score
    from fraudlens.schemas import ML_CATEGORICAL_FIELDS, ML_NUMERIC_FIELDS
    from fraudlens.session import shared_dir
    model, pred = train_and_score(sc(spark, sf_dir))
    path = shared_dir(spark, "model")
    save(model, path)
    again = score(load(path), pred.select("pq", *ML_CATEGORICAL_FIELDS, *ML_NUMERIC_FIELDS, LABEL,
                                          F.col("fraud_score").alias("before")))
    return again.agg(F.count(F.lit(1)).alias("scored"),
                     F.count(F.when(~F.col("fraud_score").eqNullSafe(F.col("before")), 1)).alias("differing"))
