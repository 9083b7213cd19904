"""Decode/encode rules (N8, N9, N10), offset bounds, preview, narrow decode."""

import json

from pyspark.sql import functions as F

from fraudlens.schemas import ENVELOPE_SCHEMA, TRANSACTION_WIRE_SCHEMA
from fraudlens.sinks.publish import publish, write_envelopes
from fraudlens.sources.envelope import (
    decode, decode_transactions, encode, files, offset_filter, preview, read_batch,
)
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

SMALL = StructType([StructField("s", StringType()), StructField("d", DoubleType()),
                    StructField("i", IntegerType())])


def _env(spark, values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_malformed_json_kept_as_null_row(spark):
    vals = ["not json", "", None, "[1,2]", '{"s":"a","s":"b"}', '{"S":"x"}',
            '{"s":1.5}', '{"s":{"k":1}}', '{"d":"2.5"}', '{"i":3.7}', '{"d":NaN}']
    got = [tuple(r) for r in decode(_env(spark, vals), SMALL).collect()]
    assert len(got) == len(vals)                       # nothing dropped
    assert got[0] == (None, None, None)                # not json
    assert got[4][0] == "b"                            # duplicate key: last wins
    assert got[5] == (None, None, None)                # keys are case-sensitive
    assert got[6][0] == "1.5"                          # number into string: its text
    assert got[7][0] == '{"k":1}'                      # object into string: its JSON
    assert got[8][1] is None                           # "2.5" into double: null
    assert got[9][2] is None                           # 3.7 into int: null


def test_encode_drops_null_fields(spark):
    df = spark.createDataFrame([("a", None, 1)], SMALL)
    v = encode(df).select(F.col("value").cast("string")).first()[0]
    assert json.loads(v) == {"s": "a", "i": 1}


def test_transaction_casts_never_fail(spark):
    rec = {f: None for f in TRANSACTION_WIRE_SCHEMA.fieldNames()}
    rec.update(price="abc", quantity="1.0", user_age="-1.9", user_income="9999999999",
               fraud_label="1", total_amount="12.5")
    out = decode_transactions(_env(spark, [json.dumps(rec)])).first()
    assert out.price is None and out.quantity == 1 and out.user_age == -1
    assert out.user_income is None and out.fraud_label == 1 and out.total_amount == 12.5


def test_narrow_decode_matches_full(spark):
    vals = [json.dumps({"transaction_id": f"t{i}", "category": "c", "fraud_label": "1"}) for i in range(5)]
    env = _env(spark, vals)
    full = decode_transactions(env).select("transaction_id", "fraud_label").collect()
    narrow = decode_transactions(env, ["transaction_id", "fraud_label"]).collect()
    assert [tuple(r) for r in full] == [tuple(r) for r in narrow]


def test_offset_bounds_and_preview(spark, scratch):
    rows = [(None, f'{{"s":"{p}-{o}"}}'.encode(), "t", p, o, None, 0)
            for p in range(3) for o in range(10)]
    t = files(scratch("topics"))
    write_envelopes(spark, spark.createDataFrame(rows, ENVELOPE_SCHEMA), t)
    env = read_batch(spark, t, "t", {"t": {"1": 5}}, {"t": {"0": 3, "2": -2}})
    got = sorted((r.partition, r.offset) for r in env.collect())
    assert got == [(0, 0), (0, 1), (0, 2)] + [(1, o) for o in range(5, 10)]
    first = [(r.partition, r.offset) for r in preview(read_batch(spark, t, "t"), 4).collect()]
    assert first == [(0, 0), (0, 1), (0, 2), (0, 3)]


def test_publish_roundtrip_and_offsets_grow(spark, scratch):
    t = files(scratch("pub"))
    df = spark.createDataFrame([("a", 1.0, 1), ("b", None, 2)], SMALL)
    publish(spark, df, t, "x")
    publish(spark, df, t, "x")
    env = read_batch(spark, t, "x")
    assert env.count() == 4
    assert env.select("offset").distinct().count() == 4
    back = sorted(tuple(r) for r in decode(env, SMALL).collect())
    assert back == sorted([("a", 1.0, 1), ("b", None, 2)] * 2)


def test_compacted_keeps_newest_message_per_key(spark, scratch):
    from fraudlens.sources.envelope import compacted
    t = files(scratch("compact"))
    first = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], SMALL)
    second = spark.createDataFrame([("a", 9.0, 2)], SMALL)
    publish(spark, first, t, "r")
    publish(spark, second, t, "r")
    env = read_batch(spark, t, "r")
    v = F.col("value").cast("string")
    latest = decode(compacted(env, F.get_json_object(v, "$.s")), SMALL)
    assert sorted(tuple(r) for r in latest.collect()) == [("a", 9.0, 2), ("b", 2.0, 1)]
