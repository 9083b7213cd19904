"""Synthetic supply-chain lines with fraud trends (the data generator).

Rows come from ``spark.range``; every field is a seeded hash draw of the row
id, so the table is identical at any partition count and on any cluster
(unlike ``rand(seed)``, whose stream depends on the partitioning).  Ids are
``PC-<i>``, ``PQ-<i>``, ``POSO-<i>`` for i = 1..rows: unique by construction.
The label is a Bernoulli draw of the additive risk rule.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions import draw_label, fraud_probability, hash_unit
from fraudlens.functions.fraud import BASE_FRAUD_PROBABILITY

# Category domains of the generator.
REGIONS = ["North America", "Europe", "Asia", "South America", "Africa"]
PRODUCTS = ["Electronics", "Furniture", "Pharmaceuticals", "Automobiles", "Clothing"]
SHIPMENT_MODES = ["Sea", "Air", "Road"]
FULFILL_VIA = ["Warehouse", "Direct"]
VENDORS = ["Vendor A", "Vendor B", "Vendor C", "Vendor D"]
MANAGERS = ["Manager A", "Manager B", "Manager C"]
SUB_CLASSIFICATIONS = ["Type A", "Type B", "Type C"]
SHIPMENT_STATUSES = ["In Transit", "Delivered", "Pending", "Delayed"]
CARRIERS = ["DHL", "FedEx", "UPS", "BlueDart", "USPS"]
# Numeric ranges (inclusive) and date offsets in seconds.
INCO_TERMS = (1, 5)
ITEMS = (1, 100)
UNITS = (1, 500)
SHIPPING_COST = (50.0, 2000.0)
WEIGHT = (1.0, 500.0)
FREIGHT = (50.0, 2000.0)
PO_OFFSET = (1000, 5000)
SCHEDULED_OFFSET = (10000, 20000)
DELIVERED_OFFSET = (30000, 40000)
RECORDED_OFFSET = (50000, 60000)

# Fields the original generator declared but never filled; our own domains.
BRANDS = ["Brand A", "Brand B", "Brand C", "Generic"]
DOSAGES = ["10mg", "50mg", "100mg", "200mg"]
DOSAGE_FORMS = ["Tablet", "Capsule", "Oral solution", "Injection"]
PACK_UNITS = ["10", "30", "60", "100"]
SITES = ["Site 1", "Site 2", "Site 3"]
YES_NO = ["Yes", "No"]
QUANTITY = (1, 1000)
UNIT_PRICE = (0.5, 100.0)
INSURANCE_RATE = (0.001, 0.02)

DEFAULT_START = dt.datetime(2024, 1, 1)
DEFAULT_END = dt.datetime(2025, 1, 1)


def _u(seed: int, salt: str) -> Column:
    return hash_unit(seed, F.lit(salt), F.col("id"))


def _choice(seed: int, salt: str, values) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    i = F.floor(_u(seed, salt) * len(values)).cast("int")
    return F.element_at(arr, i + 1)


def _int_between(seed: int, salt: str, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(_u(seed, salt) * (hi - lo + 1))).cast("int")


def _money(seed: int, salt: str, lo: float, hi: float) -> Column:
    return F.round(F.lit(lo) + _u(seed, salt) * (hi - lo), 2)


def synth_supply(spark: SparkSession, rows: int = 1_000_000, seed: int = 42,
                 base: float = BASE_FRAUD_PROBABILITY,
                 start: dt.datetime = DEFAULT_START, end: dt.datetime = DEFAULT_END,
                 num_partitions: int | None = None) -> DataFrame:
    span = int((end - start).total_seconds())
    ids = spark.range(1, rows + 1, numPartitions=num_partitions)
    t0 = F.lit(start).cast("timestamp")
    first = F.floor(_u(seed, "first") * (span + 1)).cast("long")

    def at(offset: Column) -> Column:
        return F.timestamp_seconds(F.unix_seconds(t0) + first + offset)

    sid = F.col("id").cast("string")
    df = ids.select(
        "id",
        F.concat(F.lit("PC-"), sid).alias("project_code"),
        F.concat(F.lit("PQ-"), sid).alias("pq"),
        F.concat(F.lit("POSO-"), sid).alias("po_so"),
        _choice(seed, "country", REGIONS).alias("country"),
        _choice(seed, "manager", MANAGERS).alias("managed_by"),
        _choice(seed, "fulfil", FULFILL_VIA).alias("fulfill_via"),
        F.concat(F.lit("INCO-"), _int_between(seed, "inco", *INCO_TERMS).cast("string")).alias("vendor_inco_term"),
        _choice(seed, "mode", SHIPMENT_MODES).alias("shipment_mode"),
        at(F.lit(0)).alias("pq_first_sent_to_client_date"),
        at(_int_between(seed, "po", *PO_OFFSET)).alias("po_sent_to_vendor_date"),
        at(_int_between(seed, "sched", *SCHEDULED_OFFSET)).alias("scheduled_delivery_date"),
        at(_int_between(seed, "deliv", *DELIVERED_OFFSET)).alias("delivered_to_client_date"),
        at(_int_between(seed, "rec", *RECORDED_OFFSET)).alias("delivery_recorded_date"),
        _choice(seed, "product", PRODUCTS).alias("product_group"),
        _choice(seed, "subclass", SUB_CLASSIFICATIONS).alias("sub_classification"),
        _choice(seed, "vendor", VENDORS).alias("vendor"),
        F.concat(F.lit("Item-"), _int_between(seed, "item", *ITEMS).cast("string")).alias("item_description"),
        _choice(seed, "status", SHIPMENT_STATUSES).alias("shipment_status"),
        _choice(seed, "carrier", CARRIERS).alias("carrier"),
        _int_between(seed, "units", *UNITS).alias("units"),
        _money(seed, "shipcost", *SHIPPING_COST).alias("shipping_cost"),
        at(F.floor(_u(seed, "ts") * (span + 1)).cast("long") - first).alias("timestamp"),
        _money(seed, "weight", *WEIGHT).alias("weight_kilograms"),
        _money(seed, "freight", *FREIGHT).alias("freight_cost_usd"),
        _choice(seed, "brand", BRANDS).alias("molecule_brand"),
        _choice(seed, "dosage", DOSAGES).alias("dosage"),
        _choice(seed, "form", DOSAGE_FORMS).alias("dosage_form"),
        _choice(seed, "pack", PACK_UNITS).alias("unit_of_measure_per_pack"),
        _choice(seed, "site", SITES).alias("manufacturing_site"),
        _choice(seed, "firstline", YES_NO).alias("first_line_designation"),
        _int_between(seed, "qty", *QUANTITY).cast("double").alias("line_item_quantity"),
        _money(seed, "uprice", *UNIT_PRICE).alias("unit_price"),
        (F.lit(INSURANCE_RATE[0]) + _u(seed, "ins") * (INSURANCE_RATE[1] - INSURANCE_RATE[0])).alias("_ins"),
    )
    df = (df.withColumn("line_item_value", F.round(F.col("line_item_quantity") * F.col("unit_price"), 2))
            .withColumn("pack_price", F.round(F.col("unit_price") * F.col("unit_of_measure_per_pack").cast("double"), 2))
            .withColumn("line_item_insurance_usd", F.round(F.col("line_item_value") * F.col("_ins"), 2))
            .drop("_ins"))
    p = fraud_probability("freight_cost_usd", "shipment_mode", "country", base=base)
    return (df.withColumn("fraud_probability", p)
              .withColumn("fraud_label", draw_label(F.col("fraud_probability"), seed, F.col("id")))
              .drop("fraud_probability"))
