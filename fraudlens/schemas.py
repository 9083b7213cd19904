"""Record schemas of the two record families and the spelling alias table.

Both families travel as flat JSON objects.  The wire schema is fixed and
explicit (no inference, no evolution); every field is nullable.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Field names and types of the e-commerce transaction record.
# Every field is a string on the wire; six are cast after decoding.
# ---------------------------------------------------------------------------
TRANSACTION_FIELDS = [
    "transaction_id", "user_id", "product_id", "category", "sub_category",
    "price", "quantity", "total_amount", "payment_method", "timestamp",
    "user_device", "user_city", "user_age", "user_gender", "user_income",
    "fraud_label",
]
TRANSACTION_DOUBLES = ["price", "total_amount"]
TRANSACTION_INTS = ["quantity", "user_age", "user_income", "fraud_label"]

TRANSACTION_WIRE_SCHEMA = StructType(
    [StructField(name, StringType(), True) for name in TRANSACTION_FIELDS]
)

# ---------------------------------------------------------------------------
# Canonical supply-line record (snake_case).  Quantity and the
# six money/weight fields are doubles; the label stays a string ("1" is
# fraud, "1.0" is not).
# ---------------------------------------------------------------------------
SUPPLY_RECORD = [
    ("project_code", "string"), ("pq", "string"), ("po_so", "string"), ("country", "string"),
    ("managed_by", "string"), ("fulfill_via", "string"), ("vendor_inco_term", "string"),
    ("shipment_mode", "string"), ("pq_first_sent_to_client_date", "string"),
    ("po_sent_to_vendor_date", "string"), ("scheduled_delivery_date", "string"),
    ("delivered_to_client_date", "string"), ("delivery_recorded_date", "string"),
    ("product_group", "string"), ("sub_classification", "string"), ("vendor", "string"),
    ("item_description", "string"), ("molecule_brand", "string"), ("dosage", "string"),
    ("dosage_form", "string"), ("unit_of_measure_per_pack", "string"),
    ("line_item_quantity", "double"), ("line_item_value", "double"), ("pack_price", "double"),
    ("unit_price", "double"), ("manufacturing_site", "string"), ("first_line_designation", "string"),
    ("weight_kilograms", "double"), ("freight_cost_usd", "double"),
    ("line_item_insurance_usd", "double"), ("fraud_label", "string"),
]
SUPPLY_FIELDS = [name for name, _ in SUPPLY_RECORD]
SUPPLY_NUMERIC_FIELDS = [name for name, kind in SUPPLY_RECORD if kind == "double"]
SUPPLY_SCHEMA = StructType([
    StructField(name, DoubleType() if kind == "double" else StringType(), True)
    for name, kind in SUPPLY_RECORD])

# Categorical and numeric inputs of the fraud classifier, in model order.
ML_CATEGORICAL_FIELDS = [
    "country", "managed_by", "fulfill_via", "vendor_inco_term",
    "shipment_mode", "product_group", "sub_classification", "vendor",
    "first_line_designation", "molecule_brand", "dosage", "dosage_form",
    "manufacturing_site",
]
ML_NUMERIC_FIELDS = [
    "line_item_quantity", "line_item_value", "pack_price", "unit_price",
    "weight_kilograms", "freight_cost_usd", "line_item_insurance_usd",
]

# ---------------------------------------------------------------------------
# Envelope of a message on a topic (the public Kafka source schema).  The
# file transport stores exactly these columns.
# ---------------------------------------------------------------------------
ENVELOPE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True),
])

# ---------------------------------------------------------------------------
# Spellings of the supply-line fields met in the wild, mapped
# to the canonical name.  Upper-case words with spaces ("display" form) and
# with underscores, each optionally under the "cf1:" column family prefix,
# are generated from DISPLAY_NAMES below; the irregular spellings follow.
# ---------------------------------------------------------------------------
DISPLAY_NAMES = {
    "project_code": "Project Code",
    "pq": "PQ#",
    "po_so": "PO_SO#",
    "country": "Country",
    "managed_by": "Managed By",
    "fulfill_via": "Fulfill Via",
    "vendor_inco_term": "Vendor INCO Term",
    "shipment_mode": "Shipment Mode",
    "pq_first_sent_to_client_date": "PQ First Sent to Client Date",
    "po_sent_to_vendor_date": "PO Sent to Vendor Date",
    "scheduled_delivery_date": "Scheduled Delivery Date",
    "delivered_to_client_date": "Delivered to Client Date",
    "delivery_recorded_date": "Delivery Recorded Date",
    "product_group": "Product Group",
    "sub_classification": "Sub Classification",
    "vendor": "Vendor",
    "item_description": "Item Description",
    "molecule_brand": "Molecule Brand",
    "dosage": "Dosage",
    "dosage_form": "Dosage Form",
    "unit_of_measure_per_pack": "Unit of Measure Per Pack",
    "line_item_quantity": "Line Item Quantity",
    "line_item_value": "Line Item Value",
    "pack_price": "Pack Price",
    "unit_price": "Unit Price",
    "manufacturing_site": "Manufacturing Site",
    "first_line_designation": "First Line Designation",
    "weight_kilograms": "Weight Kilograms",
    "freight_cost_usd": "Freight Cost (USD)",
    "line_item_insurance_usd": "Line Item Insurance (USD)",
    "fraud_label": "Fraud Label",
    "shipment_status": "Shipment Status",
    "carrier": "Carrier",
    "units": "Units",
    "shipping_cost": "Shipping Cost",
    "timestamp": "Timestamp",
}
IRREGULAR_ALIASES = {
    "PQ": "pq",
    "PO_SO": "po_so",
    "Weight (Kg)": "weight_kilograms",
    "Freight_Cost_USD": "freight_cost_usd",
    "Line_Item_Insurance_USD": "line_item_insurance_usd",
}
FAMILY_PREFIX = "cf1:"


def supply_aliases() -> dict[str, str]:
    """Every known spelling (S1-S7) -> canonical snake_case name."""
    out: dict[str, str] = {}
    for canon, display in DISPLAY_NAMES.items():
        underscored = display.replace(" ", "_")
        for spelling in (display, underscored, canon):
            out[spelling] = canon
            out[FAMILY_PREFIX + spelling] = canon
    for spelling, canon in IRREGULAR_ALIASES.items():
        out[spelling] = canon
        out[FAMILY_PREFIX + spelling] = canon
    return out


def spellings(canon: str) -> list[str]:
    """Every known spelling of a field, the canonical one first."""
    return [canon] + [s for s, c in supply_aliases().items() if c == canon and s != canon]
