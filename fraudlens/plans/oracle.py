"""DuckDB/ANSI SQL for every registered query that SQL can express.

The driver registers the raw tables as views; the record views ``tx`` and
``sc`` are rebuilt here as common table expressions.  Column names and
rounding match the Spark side exactly.
"""

from __future__ import annotations

from fraudlens.sources.fixtures import SC_SQL, TX_SQL

ORACLE: dict[str, str] = {}


def _with(view: str, body: str) -> str:
    src = TX_SQL if view == "tx" else SC_SQL
    return f"WITH {view} AS ({src})\n{body}"


def r(expr: str, places: int = 4) -> str:
    """Same two-step rounding as the Spark side (see queries.round_places)."""
    fine = f"{10 ** (places + 4)}.0e0"
    scale = f"{10 ** places}.0e0"
    return f"round(round(({expr}) * {fine}) / {fine} * {scale}) / {scale}"


def tx_sql(body: str) -> str:
    return _with("tx", body)


def sc_sql(body: str) -> str:
    return _with("sc", body)


AGE_CASE = """CASE WHEN user_age < 20 THEN 'Under 20' WHEN user_age < 30 THEN '20-29'
  WHEN user_age < 40 THEN '30-39' WHEN user_age < 50 THEN '40-49'
  WHEN user_age >= 50 THEN '50+' END"""
INCOME_CASE = """CASE WHEN user_income < 20000 THEN 'Under 20k' WHEN user_income < 60000 THEN '20k-59k'
  WHEN user_income < 100000 THEN '60k-99k' WHEN user_income < 140000 THEN '100k-139k'
  WHEN user_income >= 140000 THEN '140k+' END"""
COST_CASE = """CASE WHEN freight_cost_usd < 500 THEN 'Low Cost' WHEN freight_cost_usd < 1500 THEN 'Medium Cost'
  WHEN freight_cost_usd >= 1500 THEN 'High Cost' END"""


def _tx_fraud(key_expr: str, key: str) -> str:
    return tx_sql(f"""
SELECT {key_expr} AS {key},
  count(CASE WHEN fraud_label = 1 THEN 1 END) AS fraud_count,
  count(transaction_id) AS total_transactions,
  count(CASE WHEN fraud_label = 1 THEN 1 END) / nullif(count(transaction_id), 0) * 100 AS fraud_percentage
FROM tx GROUP BY 1""")


def _sc_fraud(key_expr: str, key: str) -> str:
    return sc_sql(f"""
SELECT {key_expr} AS {key},
  count(CASE WHEN fraud_label = '1' THEN 1 END) AS fraud_count,
  count(project_code) AS total_orders,
  count(CASE WHEN fraud_label = '1' THEN 1 END) / nullif(count(project_code), 0) * 100 AS fraud_percentage
FROM sc GROUP BY 1""")


def _tx_count(key_expr: str, key: str) -> str:
    return tx_sql(f"SELECT {key_expr} AS {key}, count(transaction_id) AS transaction_count FROM tx GROUP BY 1")


ORACLE.update({
    "category_analytics": tx_sql(f"""
SELECT category, {r('avg(total_amount)')} AS avg_transaction_amount,
  count(transaction_id) AS transaction_count,
  max(total_amount) AS max_transaction_amount, min(total_amount) AS min_transaction_amount
FROM tx GROUP BY category"""),
    "payment_method_analytics": _tx_count("payment_method", "payment_method"),
    "age_group_analytics": _tx_count(AGE_CASE, "age_group"),
    "city_analytics": _tx_count("user_city", "user_city"),
    "device_analytics": _tx_count("user_device", "user_device"),
    "income_analytics": tx_sql(f"""
SELECT user_income, {r('avg(total_amount)')} AS avg_transaction_amount FROM tx GROUP BY user_income"""),
    "fraud_analytics": tx_sql(f"""
SELECT category,
  sum(CASE WHEN fraud_label = 1 THEN 1 ELSE 0 END) / nullif(count(transaction_id), 0) * 100 AS fraud_percentage
FROM tx GROUP BY category"""),
    "fraud_category": _tx_fraud("category", "category"),
    "fraud_payment": _tx_fraud("payment_method", "payment_method"),
    "fraud_device": _tx_fraud("user_device", "user_device"),
    "fraud_city": _tx_fraud("user_city", "user_city"),
    "fraud_age": _tx_fraud(AGE_CASE, "age_group"),
    "fraud_income": _tx_fraud(INCOME_CASE, "income_group"),
    "product_group_analytics": sc_sql(f"""
SELECT product_group, {r('avg(line_item_value)')} AS avg_line_item_value,
  count(pq) AS total_orders, max(line_item_value) AS max_line_item_value,
  min(line_item_value) AS min_line_item_value
FROM sc GROUP BY product_group"""),
    "vendor_analytics": sc_sql(f"""
SELECT vendor, count(pq) AS total_orders, {r('avg(freight_cost_usd)')} AS avg_freight_cost
FROM sc GROUP BY vendor"""),
    "country_analytics": sc_sql(f"""
SELECT country, count(pq) AS total_orders, {r('sum(freight_cost_usd)')} AS total_freight_cost,
  {r('avg(line_item_value)')} AS avg_line_item_value
FROM sc GROUP BY country"""),
    "shipment_mode_analytics": sc_sql(f"""
SELECT shipment_mode, count(pq) AS total_orders, {r('avg(weight_kilograms)')} AS avg_weight,
  {r('sum(freight_cost_usd)')} AS total_freight_cost
FROM sc GROUP BY shipment_mode"""),
    "freight_cost_analytics": sc_sql(f"""
SELECT {r('avg(freight_cost_usd)')} AS avg_freight_cost, max(freight_cost_usd) AS max_freight_cost,
  min(freight_cost_usd) AS min_freight_cost FROM sc"""),
    "fraud_product_group": _sc_fraud("product_group", "product_group"),
    "fraud_country": _sc_fraud("country", "country"),
    "fraud_vendor": _sc_fraud("vendor", "vendor"),
    "fraud_shipment_mode": _sc_fraud("shipment_mode", "shipment_mode"),
    "fraud_freight_cost": _sc_fraud(COST_CASE, "cost_group"),
    "freight_by_project": sc_sql(f"""
SELECT project_code, {r('coalesce(sum(freight_cost_usd), 0)')} AS total_freight_cost
FROM sc WHERE project_code IS NOT NULL GROUP BY project_code"""),
    "quantity_by_product_group": sc_sql(f"""
SELECT product_group, coalesce(sum(line_item_quantity), 0) AS total_quantity
FROM sc WHERE product_group IS NOT NULL GROUP BY product_group"""),
})


def _long_fraud(view: str, dims: list[tuple[str, str]], id_col: str, fraud: str, total: str) -> str:
    parts = []
    for key_expr, key in dims:
        parts.append(f"""SELECT '{key}' AS dimension, CAST({key_expr} AS VARCHAR) AS key_value,
  count(CASE WHEN {fraud} THEN 1 END) AS fraud_count, count({id_col}) AS {total},
  count(CASE WHEN {fraud} THEN 1 END) / nullif(count({id_col}), 0) * 100 AS fraud_percentage
FROM {view} GROUP BY {key_expr}""")
    return _with(view, "\nUNION ALL\n".join(parts))


ORACLE["fraud_all_dimensions"] = _long_fraud(
    "tx",
    [("category", "category"), ("payment_method", "payment_method"),
     ("user_device", "user_device"), ("user_city", "user_city"),
     (AGE_CASE, "age_group"), (INCOME_CASE, "income_group")],
    "transaction_id", "fraud_label = 1", "total_transactions")
ORACLE["supply_fraud_all_dimensions"] = _long_fraud(
    "sc",
    [("product_group", "product_group"), ("country", "country"), ("vendor", "vendor"),
     ("shipment_mode", "shipment_mode"), (COST_CASE, "cost_group")],
    "project_code", "fraud_label = '1'", "total_orders")


def _label_share(key: str) -> str:
    return sc_sql(f"""
SELECT {key},
  count(CASE WHEN fraud_label = '0' THEN 1 END) / count(fraud_label) * 100 AS pct_label_0,
  count(CASE WHEN fraud_label = '1' THEN 1 END) / count(fraud_label) * 100 AS pct_label_1
FROM sc WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(fraud_label) > 0""")


ORACLE.update({
    "label_share_product_group": _label_share("product_group"),
    "label_share_country": _label_share("country"),
    "label_share_country_long": sc_sql(f"""
SELECT country, fraud_label AS label,
  count(*) / sum(count(*)) OVER (PARTITION BY country) * 100 AS share_pct
FROM sc WHERE country IS NOT NULL AND fraud_label IS NOT NULL GROUP BY country, fraud_label"""),
    "freight_histogram": sc_sql(f"""
, b AS (SELECT min(freight_cost_usd) AS lo, max(freight_cost_usd) AS hi FROM sc)
SELECT bin, {r('lo + (hi - lo) * bin / 20.0e0', 6)} AS bin_lo,
  {r('lo + (hi - lo) * (bin + 1) / 20.0e0', 6)} AS bin_hi, count(*) AS count
FROM (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0
        ELSE least(floor((freight_cost_usd - b.lo) / (b.hi - b.lo) * 20), 19) END AS INTEGER) AS bin, b.lo, b.hi
      FROM sc, b WHERE freight_cost_usd IS NOT NULL) t
GROUP BY bin, lo, hi"""),
    "shipment_mode_counts": sc_sql(f"""
SELECT shipment_mode, count(*) AS count FROM sc WHERE shipment_mode IS NOT NULL
GROUP BY shipment_mode ORDER BY count DESC, shipment_mode"""),
    "weight_vs_freight": sc_sql("SELECT weight_kilograms, freight_cost_usd, fraud_label FROM sc"),
    "age_group": tx_sql(f"SELECT user_age, {AGE_CASE} AS age_group, count(*) AS n FROM tx GROUP BY user_age"),
    "income_group": tx_sql(f"SELECT user_income, {INCOME_CASE} AS income_group, count(*) AS n FROM tx GROUP BY user_income"),
    "cost_group": sc_sql(f"SELECT pq, freight_cost_usd, {COST_CASE} AS cost_group FROM sc"),
    "fraud_probability": sc_sql(f"""
SELECT country, fraud_probability, count(*) AS line_count FROM (
  SELECT country, 0.05e0
    + CASE WHEN freight_cost_usd > 1500 THEN 0.1e0 ELSE 0.0e0 END
    + CASE WHEN shipment_mode = 'Air' THEN 0.05e0 ELSE 0.0e0 END
    + CASE WHEN country IN ('ASIA', 'AMERICA') THEN 0.05e0 ELSE 0.0e0 END AS fraud_probability
  FROM sc) t GROUP BY country, fraud_probability"""),
})


# ---------------------------------------------------------------------------
# Sources, codecs, casts, sinks
# ---------------------------------------------------------------------------

# Fixed value: the leading number of a text, as JavaScript's parseFloat reads
# it (written here on its own, not taken from the code under test).
LEADING_NUMBER = r"^\s*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)"

# The supply record's fields in order.
_SC_FIELDS = """project_code, pq, po_so, country, managed_by, fulfill_via, vendor_inco_term, shipment_mode,
  pq_first_sent_to_client_date, po_sent_to_vendor_date, scheduled_delivery_date, delivered_to_client_date,
  delivery_recorded_date, product_group, sub_classification, vendor, item_description, molecule_brand, dosage,
  dosage_form, unit_of_measure_per_pack, line_item_quantity, line_item_value, pack_price, unit_price,
  manufacturing_site, first_line_designation, weight_kilograms, freight_cost_usd, line_item_insurance_usd,
  fraud_label"""
_TX_FRAUD_BODY = """count(CASE WHEN fraud_label = 1 THEN 1 END) AS fraud_count,
  count(transaction_id) AS total_transactions,
  count(CASE WHEN fraud_label = 1 THEN 1 END) / nullif(count(transaction_id), 0) * 100 AS fraud_percentage"""


def _legacy_int(text: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS INTEGER)"


ORACLE.update({
    "src_envelope_batch": tx_sql(f"""
SELECT fixture_partition AS "partition", count(*) AS messages, count(transaction_id) AS with_id,
  count(CASE WHEN fraud_label = 1 THEN 1 END) AS fraud_count
FROM tx
WHERE (fixture_partition <> 1 OR fixture_offset >= {1 << 58})
  AND (fixture_partition <> 0 OR fixture_offset < {3 << 58})
GROUP BY fixture_partition"""),
    "decode_transactions": tx_sql("""
SELECT transaction_id, user_id, product_id, category, sub_category, price, quantity, total_amount,
  payment_method, "timestamp", user_device, user_city, user_age, user_gender, user_income, fraud_label
FROM tx"""),
    "decode_narrow_fraud_category": tx_sql(f"SELECT category, {_TX_FRAUD_BODY} FROM tx GROUP BY category"),
    "encode_roundtrip": tx_sql(f"SELECT category, {_TX_FRAUD_BODY} FROM tx GROUP BY category"),
    "audit_count": tx_sql("SELECT count(*) AS total_rows, count(transaction_id) AS rows_with_id FROM tx"),
    "preview_100": tx_sql("""
SELECT fixture_partition AS "partition", fixture_offset AS "offset", transaction_id, category, total_amount
FROM tx ORDER BY fixture_partition, fixture_offset LIMIT 100"""),
    "cast_transactions": tx_sql(f"""
SELECT transaction_id, price,
  {_legacy_int("CAST(quantity AS VARCHAR) || '.7'")} AS quantity,
  total_amount,
  {_legacy_int("CASE WHEN user_age % 10 = 0 THEN 'abc' ELSE CAST(user_age AS VARCHAR) END")} AS user_age,
  {_legacy_int("CAST(CAST(user_income AS BIGINT) * 100000 AS VARCHAR)")} AS user_income,
  {_legacy_int("'-' || CAST(fraud_label AS VARCHAR) || '.9'")} AS fraud_label
FROM tx"""),
    "parse_float_lenient": f"""
SELECT raw, TRY_CAST(NULLIF(regexp_extract(raw, '{LEADING_NUMBER}', 1), '') AS DOUBLE) AS parsed,
  count(*) AS n
FROM (SELECT CASE l_linenumber % 4
    WHEN 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'kg'
    WHEN 1 THEN ' -' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'e2x'
    WHEN 2 THEN l_returnflag
    ELSE '.' || CAST(l_linenumber AS VARCHAR) END AS raw
  FROM lineitem) t
GROUP BY raw""",
    "normalize_supply": sc_sql("""
SELECT project_code, pq, country, vendor, product_group, shipment_mode, freight_cost_usd, fraud_label FROM sc"""),
    "wide_cells": sc_sql("\nUNION ALL\n".join(
        f"SELECT pq AS row_key, 'cf1' AS family, '{c}' AS qualifier, coalesce({c}, '') AS value FROM sc"
        for c in ["country", "product_group", "fraud_label", "vendor"])),
    "publish_readback": tx_sql("\nUNION ALL\n".join(
        f"SELECT '{name}' AS topic, CAST({expr} AS VARCHAR) AS key_value, {_TX_FRAUD_BODY} FROM tx GROUP BY {expr}"
        for name, expr in [("fraud_category", "category"), ("fraud_payment", "payment_method"),
                           ("fraud_device", "user_device"), ("fraud_city", "user_city"),
                           ("fraud_age", AGE_CASE), ("fraud_income", INCOME_CASE)])),
    "wide_upsert": sc_sql(f"""
SELECT {_SC_FIELDS}, _partition, _offset FROM (
  SELECT {_SC_FIELDS}, fixture_partition AS _partition, fixture_offset AS _offset,
    row_number() OVER (PARTITION BY pq ORDER BY l_shipdate DESC, fixture_partition DESC,
                                                 fixture_offset DESC) AS rn
  FROM sc) t WHERE rn = 1"""),
    "decode_supply_spelled": sc_sql(f"SELECT l_linenumber % 5 AS spelling, {_SC_FIELDS} FROM sc"),
    "ingest_csv": sc_sql("""
SELECT project_code, pq, country, vendor, product_group, shipment_mode, line_item_quantity,
  weight_kilograms, freight_cost_usd, fraud_label FROM sc"""),
    "oversample": sc_sql("\nUNION ALL\n".join(
        f"SELECT country, {k} AS copy, count(*) AS n, count(DISTINCT pq) AS distinct_pq FROM sc GROUP BY country"
        for k in (1, 2, 3))),
})


# ---------------------------------------------------------------------------
# Streaming and machine learning
# ---------------------------------------------------------------------------

ORACLE.update({
    "stream_decode": ORACLE["decode_transactions"],
    "stream_fraud_category": ORACLE["fraud_category"],
    "stream_fraud_fan_out": ORACLE["publish_readback"],
    "index_shipment_mode": sc_sql("""
SELECT shipment_mode,
  CAST(row_number() OVER (ORDER BY count(*) DESC, shipment_mode) - 1 AS DOUBLE) AS shipment_mode_index,
  count(*) AS n
FROM sc GROUP BY shipment_mode"""),
    "auc_fraud_probability": sc_sql(f"""
, s AS (
  SELECT 0.05e0
    + CASE WHEN freight_cost_usd > 1500 THEN 0.1e0 ELSE 0.0e0 END
    + CASE WHEN shipment_mode = 'Air' THEN 0.05e0 ELSE 0.0e0 END
    + CASE WHEN country IN ('ASIA', 'AMERICA') THEN 0.05e0 ELSE 0.0e0 END AS score,
    CASE WHEN fraud_label = '1' THEN 1 ELSE 0 END AS y
  FROM sc)
, g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score)
, c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM g)
SELECT {r("sum(pos * (neg_below + 0.5e0 * neg)) / ((SELECT sum(pos) FROM g) * (SELECT sum(neg) FROM g))", 10)} AS auc
FROM c"""),
})

ORACLE.update({
    "report_store": tx_sql("\nUNION ALL\n".join(
        f"SELECT CASE WHEN {expr} IS NULL THEN '{name}' ELSE '{name}#' || CAST({expr} AS VARCHAR) END AS row_key, "
        f"'{name}' AS report, {_TX_FRAUD_BODY} FROM tx GROUP BY {expr}"
        for name, expr in [("fraud_category", "CASE WHEN category IS NOT NULL AND user_device = 'Tablet' "
                                              "THEN '' ELSE category END"), ("fraud_payment", "payment_method"),
                           ("fraud_device", "user_device"), ("fraud_city", "user_city"),
                           ("fraud_age", AGE_CASE), ("fraud_income", INCOME_CASE)])),
    **{f"dashboard_{name}": ORACLE[name] for name in (
        "label_share_product_group", "label_share_country", "shipment_mode_counts", "quantity_by_product_group",
        "freight_by_project", "freight_histogram")},
    "stream_income_analytics": ORACLE["income_analytics"],
    "stream_raw": tx_sql("""
SELECT 'transactions' AS topic, fixture_partition AS partition, fixture_offset AS "offset", transaction_id, category,
  CAST(fraud_label AS VARCHAR) AS fraud_label FROM tx"""),
})


def unit(seed: int, *texts: str) -> str:
    """The seeded draw in [0, 1): 52 bits of the md5 of seed and texts."""
    text = " || '|' || ".join([f"'{seed}'", *texts])
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS UBIGINT) / 4503599627370496.0e0)"


_RISK = """0.05e0
    + CASE WHEN freight_cost_usd > 1500 THEN 0.1e0 ELSE 0.0e0 END
    + CASE WHEN shipment_mode = 'Air' THEN 0.05e0 ELSE 0.0e0 END
    + CASE WHEN country IN ('ASIA', 'AMERICA') THEN 0.05e0 ELSE 0.0e0 END"""
# The model's categorical fields.
_CATEGORICAL = ("country managed_by fulfill_via vendor_inco_term shipment_mode product_group sub_classification "
                "vendor first_line_designation molecule_brand dosage dosage_form manufacturing_site").split()
ORACLE.update({
    "train_test_split": sc_sql(f"""
SELECT CAST(CASE WHEN {unit(42, 'pq')} < 0.8e0 THEN 0 ELSE 1 END AS INTEGER) AS split, country, count(*) AS n
FROM sc GROUP BY 1, 2"""),
    "draw_label": sc_sql(f"""
SELECT country, p, count(*) AS n, avg(CASE WHEN {unit(42, "'label'", 'pq')} < p THEN 1 ELSE 0 END) AS drawn_rate
FROM (SELECT pq, country, {_RISK} AS p FROM sc) t GROUP BY country, p"""),
    "weight_vs_freight_sample": sc_sql(f"""
SELECT weight_kilograms, freight_cost_usd, fraud_label FROM sc WHERE {unit(42, 'pq')} < 0.1e0"""),
    "score_transactions_rows": sc_sql(f"""
SELECT pq, CASE fraud_label WHEN '1' THEN 1.0e0 WHEN '0' THEN 0.0e0 END AS label, true AS in_range, true AS consistent
FROM sc WHERE {unit(42, 'pq')} >= 0.8e0"""),
    "index_all_columns": sc_sql("\nUNION ALL\n".join(f"""
SELECT '{c}' AS field, {c} AS value, CAST(CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM sc)
    ELSE row_number() OVER (ORDER BY {c} IS NULL, count(*) DESC, {c}) - 1 END AS DOUBLE) AS idx, count(*) AS n
FROM sc GROUP BY {c}""" for c in _CATEGORICAL)),
})


def _stacked(names: list[tuple[str, str | None, list[str]]]) -> str:
    """Reports stacked: report, key as text, all measures of the set."""
    measures = list(dict.fromkeys(m for _, _, own in names for m in own))
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS report, CAST({key or 'NULL'} AS VARCHAR) AS key_value, "
        + ", ".join(m if m in own else f"NULL AS {m}" for m in measures) + f" FROM ({ORACLE[n]}) t"
        for n, key, own in names)


ORACLE["ecommerce_summary_fused"] = _stacked([
    ("category_analytics", "category", ["avg_transaction_amount", "transaction_count", "max_transaction_amount",
                                        "min_transaction_amount"]),
    ("payment_method_analytics", "payment_method", ["transaction_count"]),
    ("age_group_analytics", "age_group", ["transaction_count"]),
    ("city_analytics", "user_city", ["transaction_count"]),
    ("device_analytics", "user_device", ["transaction_count"]),
    ("income_analytics", "user_income", ["avg_transaction_amount"]),
    ("fraud_analytics", "category", ["fraud_percentage"])])
ORACLE["supply_summary_fused"] = _stacked([
    ("product_group_analytics", "product_group", ["avg_line_item_value", "total_orders", "max_line_item_value",
                                                  "min_line_item_value"]),
    ("vendor_analytics", "vendor", ["total_orders", "avg_freight_cost"]),
    ("country_analytics", "country", ["total_orders", "total_freight_cost", "avg_line_item_value"]),
    ("shipment_mode_analytics", "shipment_mode", ["total_orders", "avg_weight", "total_freight_cost"]),
    ("freight_cost_analytics", None, ["avg_freight_cost", "max_freight_cost", "min_freight_cost"])])
ORACLE["publish_script_spelled"] = _stacked([
    (n, key, ["fraud_count", "total_orders", "fraud_percentage"]) for n, key in [
        ("fraud_product_group", "product_group"), ("fraud_country", "country"), ("fraud_vendor", "vendor"),
        ("fraud_shipment_mode", "shipment_mode"), ("fraud_freight_cost", "cost_group")]])

ORACLE["stream_fraud_category_updates"] = ORACLE["fraud_category"]

# The model's numeric fields.
_NUMERIC = ("line_item_quantity line_item_value pack_price unit_price weight_kilograms freight_cost_usd "
            "line_item_insurance_usd").split()
_LIMITED = "transaction_id, CAST(fraud_label AS INTEGER) AS fraud_label"
ORACLE.update({
    "stream_rate_limited": tx_sql(f"SELECT {_LIMITED}, TRUE AS bounded, TRUE AS several FROM tx"),
    "stream_restart": tx_sql(f"SELECT {_LIMITED}, category FROM tx"),
    "stream_from_latest": tx_sql(f"SELECT {_LIMITED}, category FROM tx WHERE fixture_offset >= {1 << 59}"),
    "stream_publish_complete": ORACLE["fraud_category"],
    "stream_observed_counts": ORACLE["audit_count"],
    "ingest_csv_count": sc_sql("SELECT count(*) AS observed, count(*) AS read_back FROM sc"),
    "csv_roundtrip": tx_sql("""
SELECT transaction_id, 'said "' || category || '", ' || user_city AS quoted, chr(92) || user_device || chr(92) AS slashed,
  CASE user_age % 3 WHEN 0 THEN 'empty' WHEN 1 THEN ',"' ELSE 'missing' END AS odd FROM tx"""),
    "feature_cells": sc_sql("\nUNION ALL\n".join([
        *[f"SELECT '{c}_imputed' AS feature, {r(f'coalesce({c}, (SELECT avg({c}) FROM sc))', 6)} AS value, "
          "count(*) AS n FROM sc GROUP BY 2" for c in _NUMERIC],
        *[f"""
SELECT '{c}_index' AS feature, CAST(CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM sc)
    ELSE row_number() OVER (ORDER BY {c} IS NULL, count(*) DESC, {c}) - 1 END AS DOUBLE) AS value, count(*) AS n
FROM sc GROUP BY {c}""" for c in _CATEGORICAL]])),
    "lr_gradient": "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, TRUE AS optimal" for f in
        ["(intercept)", *[f"{c}_imputed" for c in _NUMERIC], *[f"{c}_index" for c in _CATEGORICAL]]),
    "model_reload": sc_sql(f"SELECT count(*) AS scored, 0 AS differing FROM sc WHERE {unit(42, 'pq')} >= 0.8e0"),
})
