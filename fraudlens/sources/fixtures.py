"""Record views built from the driver's star-schema tables.

``transactions`` (view ``tx``) and ``supply_lines`` (view ``sc``) shape the
TPC-H-like tables into the two record families; grain is the line item.
The fact side is never broadcast.  Dimensions (nation, region, customer,
supplier, part) are broadcast only after a bounded row-count check and
shuffle-joined otherwise; line items and orders, which both grow with the
data, always meet in a shuffle join on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.plans.joins import join_dimension, join_large, spread


SOURCE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("l_orderkey").cast("string"), F.lit("-"),
                    F.col("l_linenumber").cast("string"))


def _label(as_string: bool) -> Column:
    one, zero = ("1", "0") if as_string else (1, 0)
    return (F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 5), F.lit(one))
            .when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1), F.lit(None))
            .otherwise(F.lit(zero)))


def _unless_size50(c: str) -> Column:
    return F.when(F.col("p_size") != 50, F.col(c))


def transactions(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """View ``tx``: typed e-commerce transactions (after the six casts).
    ``with_source`` adds the line-item key columns and order date."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")

    # Orders are enriched with their customer and nation first: that join
    # runs at order grain (a quarter of the line items) before the big one.
    cust = join_dimension(customer, nation, F.col("c_nationkey") == F.col("n_nationkey"))
    ord_c = join_dimension(orders, cust, F.col("o_custkey") == F.col("c_custkey"))
    df = join_large(li, ord_c, F.col("l_orderkey") == F.col("o_orderkey"))
    df = join_dimension(df, part, F.col("l_partkey") == F.col("p_partkey"))
    key = F.col("c_custkey")
    return df.select(
        F.when(F.col("l_linenumber") != 7, _line_id("T-")).alias("transaction_id"),
        F.concat(F.lit("U-"), key.cast("string")).alias("user_id"),
        F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("product_id"),
        _unless_size50("p_type").alias("category"),
        _unless_size50("p_brand").alias("sub_category"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(key % 3 == 0, "Mobile").when(key % 3 == 1, "Desktop")
         .otherwise("Tablet").alias("user_device"),
        F.col("n_name").alias("user_city"),
        F.when(key % 97 != 0, (F.lit(15) + key % 60).cast("int")).alias("user_age"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("user_gender"),
        F.floor(F.col("c_acctbal") * 20).cast("int").alias("user_income"),
        _label(as_string=False).cast("int").alias("fraud_label"),
        *([F.col(c) for c in SOURCE_COLUMNS] + [F.col("o_orderdate")] if with_source else []),
    )


def supply_lines(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """View ``sc``: canonical supply-chain lines with a string label.
    ``with_source`` adds the line-item key columns and ship date."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")

    geo = join_dimension(nation, region, F.col("n_regionkey") == F.col("r_regionkey"))
    supp = join_dimension(supplier, geo, F.col("s_nationkey") == F.col("n_nationkey"))
    # Only dimension joins follow, so nothing else would spread the scan.
    df = join_dimension(spread(li), supp, F.col("l_suppkey") == F.col("s_suppkey"))
    df = join_dimension(df, part, F.col("l_partkey") == F.col("p_partkey"))
    ship = F.date_format("l_shipdate", "yyyy-MM-dd")
    mode = F.col("l_linenumber") % 3
    return df.select(
        F.when(F.col("l_linenumber") != 7, _line_id("PC-")).alias("project_code"),
        _line_id("PQ-").alias("pq"),
        _line_id("POSO-").alias("po_so"),
        F.col("r_name").alias("country"),
        F.concat(F.lit("Manager "), (F.col("l_suppkey") % 3).cast("string")).alias("managed_by"),
        F.when(F.col("l_linestatus") == "O", "Direct").otherwise("Warehouse").alias("fulfill_via"),
        F.concat(F.lit("INCO-"), (F.col("l_suppkey") % 5 + 1).cast("string")).alias("vendor_inco_term"),
        F.when(mode == 0, "Sea").when(mode == 1, "Air").otherwise("Road").alias("shipment_mode"),
        ship.alias("pq_first_sent_to_client_date"),
        ship.alias("po_sent_to_vendor_date"),
        ship.alias("scheduled_delivery_date"),
        ship.alias("delivered_to_client_date"),
        ship.alias("delivery_recorded_date"),
        _unless_size50("p_type").alias("product_group"),
        _unless_size50("p_brand").alias("sub_classification"),
        F.col("s_name").alias("vendor"),
        _unless_size50("p_name").alias("item_description"),
        F.col("p_brand").alias("molecule_brand"),
        F.concat(F.col("p_size").cast("string"), F.lit(" mg")).alias("dosage"),
        F.when(F.col("l_partkey") % 2 == 0, "Tablet").otherwise("Capsule").alias("dosage_form"),
        F.col("p_size").cast("string").alias("unit_of_measure_per_pack"),
        F.col("l_quantity").alias("line_item_quantity"),
        F.col("l_extendedprice").alias("line_item_value"),
        F.col("p_retailprice").alias("pack_price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.concat(F.lit("Site "), (F.col("l_suppkey") % 4).cast("string")).alias("manufacturing_site"),
        F.when(F.col("l_discount") > 0.05, "Yes").otherwise("No").alias("first_line_designation"),
        (F.col("p_size") * F.col("l_quantity") / F.lit(5.0)).alias("weight_kilograms"),
        F.when(F.col("l_quantity") != 50, F.col("l_extendedprice") / F.lit(50.0)).alias("freight_cost_usd"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("line_item_insurance_usd"),
        _label(as_string=True).alias("fraud_label"),
        *([F.col(c) for c in SOURCE_COLUMNS] + [F.col("l_shipdate")] if with_source else []),
    )


def fixture_partition() -> Column:
    """Topic partition of a line in the fixture envelopes (3 partitions)."""
    return (F.col("l_linenumber") % 3).cast("int")


def fixture_offset() -> Column:
    """Offset of a line in the fixture envelopes: 60 bits of the md5 of its
    whole key (order, line number, part, supplier), so that lines have
    different offsets at any size of the tables, in any engine."""
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in SOURCE_COLUMNS])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _envelope(records: DataFrame, fields: list[str], topic: str, ts: str) -> DataFrame:
    value = F.to_json(F.struct(*[F.col(c) for c in fields]))
    return records.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        fixture_partition().alias("partition"),
        fixture_offset().alias("offset"),
        F.col(ts).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def transaction_envelope(spark: SparkSession, sf_dir: str, topic: str = "transactions") -> DataFrame:
    """The ``tx`` records as JSON messages in the Kafka envelope."""
    from fraudlens.schemas import TRANSACTION_FIELDS
    return _envelope(transactions(spark, sf_dir, with_source=True),
                     TRANSACTION_FIELDS, topic, "o_orderdate")


def supply_envelope(spark: SparkSession, sf_dir: str, topic: str = "supply_chain_data") -> DataFrame:
    """The ``sc`` records as JSON messages in the Kafka envelope."""
    from fraudlens.schemas import SUPPLY_FIELDS
    return _envelope(supply_lines(spark, sf_dir, with_source=True),
                     SUPPLY_FIELDS, topic, "l_shipdate")


# DuckDB/ANSI text of the same two views, for oracle queries.  Only the
# columns the oracles read are spelled out.
TX_SQL = """
SELECT
  CASE WHEN l_linenumber <> 7 THEN 'T-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
  'U-' || CAST(c_custkey AS VARCHAR) AS user_id,
  'P-' || CAST(l_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_size <> 50 THEN p_type END AS category,
  CASE WHEN p_size <> 50 THEN p_brand END AS sub_category,
  l_extendedprice / l_quantity AS price,
  CAST(l_quantity AS INTEGER) AS quantity,
  l_extendedprice AS total_amount,
  o_orderpriority AS payment_method,
  CASE c_custkey % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' ELSE 'Tablet' END AS user_device,
  n_name AS user_city,
  CASE WHEN c_custkey % 97 <> 0 THEN CAST(15 + c_custkey % 60 AS INTEGER) END AS user_age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender,
  CAST(floor(c_acctbal * 20) AS INTEGER) AS user_income,
  CASE WHEN l_returnflag = 'R' AND l_linenumber >= 5 THEN 1
       WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN NULL ELSE 0 END AS fraud_label,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp",
  l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_linenumber % 3 AS fixture_partition,
  CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
    || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)), 1, 15) AS BIGINT) AS fixture_offset
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
"""

SC_SQL = """
SELECT
  CASE WHEN l_linenumber <> 7 THEN 'PC-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS project_code,
  'PQ-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS pq,
  'POSO-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS po_so,
  r_name AS country,
  'Manager ' || CAST(l_suppkey % 3 AS VARCHAR) AS managed_by,
  'INCO-' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS vendor_inco_term,
  strftime(l_shipdate, '%Y-%m-%d') AS pq_first_sent_to_client_date,
  strftime(l_shipdate, '%Y-%m-%d') AS po_sent_to_vendor_date,
  strftime(l_shipdate, '%Y-%m-%d') AS scheduled_delivery_date,
  strftime(l_shipdate, '%Y-%m-%d') AS delivered_to_client_date,
  strftime(l_shipdate, '%Y-%m-%d') AS delivery_recorded_date,
  CASE WHEN p_size <> 50 THEN p_name END AS item_description,
  p_brand AS molecule_brand,
  CAST(p_size AS VARCHAR) || ' mg' AS dosage,
  CASE WHEN l_partkey % 2 = 0 THEN 'Tablet' ELSE 'Capsule' END AS dosage_form,
  CAST(p_size AS VARCHAR) AS unit_of_measure_per_pack,
  'Site ' || CAST(l_suppkey % 4 AS VARCHAR) AS manufacturing_site,
  CASE WHEN l_discount > 0.05e0 THEN 'Yes' ELSE 'No' END AS first_line_designation,
  s_name AS vendor,
  CASE WHEN p_size <> 50 THEN p_type END AS product_group,
  CASE WHEN p_size <> 50 THEN p_brand END AS sub_classification,
  CASE l_linenumber % 3 WHEN 0 THEN 'Sea' WHEN 1 THEN 'Air' ELSE 'Road' END AS shipment_mode,
  CASE WHEN l_linestatus = 'O' THEN 'Direct' ELSE 'Warehouse' END AS fulfill_via,
  l_quantity AS line_item_quantity,
  l_extendedprice AS line_item_value,
  p_retailprice AS pack_price,
  l_extendedprice / l_quantity AS unit_price,
  p_size * l_quantity / 5.0e0 AS weight_kilograms,
  CASE WHEN l_quantity <> 50 THEN l_extendedprice / 50.0e0 END AS freight_cost_usd,
  l_extendedprice * l_tax AS line_item_insurance_usd,
  CASE WHEN l_returnflag = 'R' AND l_linenumber >= 5 THEN '1'
       WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN NULL ELSE '0' END AS fraud_label,
  l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_linenumber % 3 AS fixture_partition,
  CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
    || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)), 1, 15) AS BIGINT) AS fixture_offset
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
"""
