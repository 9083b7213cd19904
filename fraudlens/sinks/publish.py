"""Publish records or reports to topics.

One write serves any number of topics: rows carry a ``topic`` column, which
the Kafka sink routes on and the file transport turns into a
``topic=<name>`` folder.  Reports are tiny, so a fan-out of N reports is one
small job instead of N.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fraudlens.folder import Folder
from fraudlens.sources.envelope import RECORDS_PER_FILE, Transport, encode

DEFAULT_PARTITIONS = 3


TASK_STRIDE = 1 << 20            # more than the tasks of any write
NULL_KEY = "\u0000"              # message key of the group whose report key is null


def next_offset(spark: SparkSession, transport: Transport, topics) -> int:
    """One more than the largest offset in the topics' files (one pruned
    column), 0 for new topics.  Only this file transport needs it: a broker
    numbers messages itself, and orders writers that publish at the same time;
    here their messages may share offsets, but none is lost."""
    paths = [transport.topic_path(t) for t in topics if _has_files(spark, transport.topic_path(t))]
    if not paths:
        return 0
    top = spark.read.schema("offset long").parquet(*paths).agg(F.max("offset")).first()[0]
    return 0 if top is None else top + 1


def _has_files(spark: SparkSession, path: str) -> bool:
    return any(n.startswith("part-") for n in Folder(spark, path).names())


def to_envelope(encoded: DataFrame, partitions: int = DEFAULT_PARTITIONS,
                base_offset: int = 0) -> DataFrame:
    """(key, value, topic) -> full envelope for the file transport.

    The partition is a hash of the key (of the value when the key is null).
    Offsets are unique and increase within a task: the n-th row of task t gets
    ``base + n * TASK_STRIDE + t``, so a write takes about as many offsets as
    its largest task has rows, times the stride."""
    route = F.coalesce(F.col("key"), F.col("value"))
    place = F.monotonically_increasing_id()                    # task << 33 | n
    task, n = F.shiftrightunsigned(place, 33), place.bitwiseAND((1 << 33) - 1)
    return encoded.select(
        "key", "value", "topic",
        F.pmod(F.xxhash64(route), F.lit(partitions)).cast("int").alias("partition"),
        (F.lit(base_offset) + n * F.lit(TASK_STRIDE) + task).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_envelopes(spark: SparkSession, envelopes: DataFrame, transport: Transport,
                    mode: str = "append", topic: str | None = None) -> None:
    """Write envelope rows that already carry topic/partition/offset.  Rows
    that all belong to one ``topic`` go straight into its folder: a write that
    is partitioned by a column sorts every task's rows by it first.  JSON
    repeats its field names, so files are compressed by zstandard."""
    if transport.kind == "kafka":
        w = envelopes.select("key", "value", "topic").write.format("kafka").option(
            "kafka.bootstrap.servers", transport.bootstrap_servers)
        for k, v in transport.options.items():
            w = w.option(k, v)
        w.save()
        return
    w = envelopes.write.partitionBy("topic") if topic is None else envelopes.drop("topic").write
    if rows := transport.options.get(RECORDS_PER_FILE):
        w = w.option("maxRecordsPerFile", int(rows))
    w.mode(mode).option("compression", "zstd").parquet(transport.root if topic is None else transport.topic_path(topic))


def publish_many(spark: SparkSession, frames: dict[str, DataFrame], transport: Transport,
                 partitions: int = DEFAULT_PARTITIONS, key_cols: dict | None = None) -> int:
    """Publish several DataFrames, each to its own topic, in one write, and
    return the number of messages, observed in the write itself.

    ``key_cols`` names per topic the column whose text is the message key (a
    null key gets ``NULL_KEY``), so that all versions of a row share a
    partition.  A write that fails leaves nothing behind (Spark's own commit
    protocol) and blocks nobody; one that is repeated publishes again, as a
    broker's at-least-once sink does.  The Kafka connector is not part of
    this repository, so that branch is untested."""
    key_cols = key_cols or {}
    parts = []
    for topic, df in frames.items():
        k = key_cols.get(topic)
        key = F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) if k else None
        parts.append(encode(df, key).withColumn("topic", F.lit(topic)))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    counted = Observation()
    union = union.observe(counted, F.count(F.lit(1)).alias("messages"))
    if transport.kind != "kafka":
        union = to_envelope(union, partitions, next_offset(spark, transport, frames))
    write_envelopes(spark, union, transport, "append", next(iter(frames)) if len(frames) == 1 else None)
    return counted.get["messages"]


def publish(spark: SparkSession, df: DataFrame, transport: Transport, topic: str,
            partitions: int = DEFAULT_PARTITIONS, key_col: str | None = None) -> int:
    """Publish one DataFrame as JSON messages to ``topic``; the number of
    messages."""
    return publish_many(spark, {topic: df}, transport, partitions, {topic: key_col} if key_col else None)
