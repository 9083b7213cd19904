"""Topic envelopes: bounded and streaming reads, JSON decode and encode.

A *topic* is either a Kafka topic (``transport="kafka"``; needs the Kafka
connector on the classpath) or, for local runs and tests, a folder of
Parquet files holding the same envelope columns (``transport="files"``,
``<root>/topic=<name>/``).  Both yield the public Kafka source schema, so every
operator downstream is transport-agnostic.

Offset bounds use the Kafka JSON form: ``"earliest"``, ``"latest"`` or
``{"topic": {"0": 23, "1": -2}}`` with -2 = earliest and -1 = latest; the end
bound is exclusive.  On the file transport the bounds become filters on
``partition`` and ``offset`` that Spark pushes into the Parquet scan.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fraudlens.folder import Folder
from fraudlens.functions import try_double, try_int_legacy
from fraudlens.schemas import (
    ENVELOPE_SCHEMA,
    SUPPLY_SCHEMA,
    TRANSACTION_DOUBLES,
    TRANSACTION_INTS,
    TRANSACTION_WIRE_SCHEMA,
    spellings,
)

EARLIEST, LATEST = -2, -1
RECORDS_PER_FILE = "records_per_file"            # option of the file transport: most messages in one file


@dataclass(frozen=True)
class Transport:
    """Where topics live.  ``kind`` is "kafka" or "files"."""
    kind: str = "files"
    root: str | None = None                       # files: folder of topics
    bootstrap_servers: str | None = None          # kafka
    options: dict = field(default_factory=dict)   # extra source/sink options

    def topic_path(self, topic: str) -> str:
        if self.root is None:
            raise ValueError("file transport needs a root folder")
        return f"{self.root.rstrip('/')}/topic={topic}"


def files(root: str, **options) -> Transport:
    return Transport("files", root=root, options=options)


def kafka(bootstrap_servers: str, **options) -> Transport:
    return Transport("kafka", bootstrap_servers=bootstrap_servers, options=options)


# ---------------------------------------------------------------------------
# Offset bounds
# ---------------------------------------------------------------------------

def _parse_bound(spec, topic: str) -> dict[int, int] | int:
    """Offset spec -> EARLIEST / LATEST or {partition: offset}."""
    if spec in (None, "earliest"):
        return EARLIEST
    if spec == "latest":
        return LATEST
    obj = json.loads(spec) if isinstance(spec, str) else spec
    return {int(p): int(o) for p, o in obj.get(topic, {}).items()}


def offset_filter(topic: str, starting="earliest", ending="latest") -> Column:
    """Predicate selecting start <= offset < end per partition.  Partitions
    not named in a JSON bound are unbounded on that side."""
    start = _parse_bound(starting, topic)
    end = _parse_bound(ending, topic)
    if start == LATEST:
        raise ValueError("startingOffsets=latest is not allowed for a batch read")
    cond = F.lit(True)
    if isinstance(start, dict):
        for p, o in start.items():
            if o >= 0:
                cond = cond & ((F.col("partition") != p) | (F.col("offset") >= o))
    if isinstance(end, dict):
        for p, o in end.items():
            if o == EARLIEST:
                cond = cond & (F.col("partition") != p)
            elif o >= 0:
                cond = cond & ((F.col("partition") != p) | (F.col("offset") < o))
    return cond


def _kafka_reader(reader, transport: Transport, topic: str, parallelism: int):
    """Kafka source.  ``minPartitions`` defaults to the cluster's task slots
    so that a topic partition holding a large share of the messages is
    split into several offset ranges (tasks) instead of one."""
    r = (reader.format("kafka")
         .option("kafka.bootstrap.servers", transport.bootstrap_servers)
         .option("subscribe", topic))
    opts = {"minPartitions": str(parallelism), **transport.options}
    for k, v in opts.items():
        r = r.option(k, v)
    return r


# On the file transport the topic is the folder name, not a stored column.
_FILE_SCHEMA = StructType([f for f in ENVELOPE_SCHEMA.fields if f.name != "topic"])


def _with_topic(df: DataFrame, topic: str) -> DataFrame:
    return df.select(*[F.lit(topic).alias("topic") if f.name == "topic" else F.col(f.name)
                       for f in ENVELOPE_SCHEMA.fields])


def read_batch(spark: SparkSession, transport: Transport, topic: str,
               starting="earliest", ending="latest") -> DataFrame:
    """Bounded read of a whole topic (or an offset range of it)."""
    if transport.kind == "kafka":
        r = _kafka_reader(spark.read, transport, topic, spark.sparkContext.defaultParallelism)
        start = starting if isinstance(starting, str) else json.dumps(starting)
        end = ending if isinstance(ending, str) else json.dumps(ending)
        return r.option("startingOffsets", start).option("endingOffsets", end).load()
    df = _with_topic(spark.read.schema(_FILE_SCHEMA).parquet(transport.topic_path(topic)), topic)
    if starting in (None, "earliest") and ending in (None, "latest"):
        return df
    return df.where(offset_filter(topic, starting, ending))


def latest_offsets(spark: SparkSession, transport: Transport, topic: str) -> dict:
    """Where a file topic ends now: the next offset per partition (one row per
    partition), as a bound for ``starting``."""
    ends = spark.read.schema(_FILE_SCHEMA).parquet(transport.topic_path(topic)).groupBy("partition").agg(
        F.max("offset").alias("top")).collect()
    return {topic: {str(r["partition"]): r["top"] + 1 for r in ends}}


def _starting(spark: SparkSession, transport: Transport, topic: str, checkpoint: str | None) -> dict:
    """The bound of a stream that starts at ``latest``, fixed when its
    checkpoint first asks for it: a restart goes on from the same bound."""
    if checkpoint is None:
        raise ValueError("a file topic starts at latest only with the checkpoint that keeps the bound")
    folder, name = Folder(spark, checkpoint), f"starting-{topic}.json"
    if not folder.exists(name):
        folder.write(name, latest_offsets(spark, transport, topic))
    return folder.read(name)


# Spark ends the names of a write's files with a counter before the first dot;
# no later part of the name may end in a digit, so that one share matches.
_COUNTED_FILE = re.compile(r"-c\d+(\.[^.]*[^.0-9])+$")


def _share_glob(share: tuple[int, int]) -> str:
    """Names of every ``n``-th file of a topic."""
    k, n = share
    if not 0 <= k < n <= 10:
        raise ValueError(f"share {k} of {n}: a file topic has at most ten shares")
    return "*-c*[" + "".join(str(d) for d in range(10) if d % n == k) + "].*"


def _check_shares(spark: SparkSession, transport: Transport, topic: str) -> None:
    """A file that no share would read (one that Spark did not name) is an
    error, not left out."""
    odd = [f for f in Folder(spark, transport.topic_path(topic)).names()
           if f[0] not in "._" and not _COUNTED_FILE.search(f)]
    if odd:
        raise ValueError(f"{topic}: {odd[0]} has no file counter, so it belongs to no share")


def read_shares(spark: SparkSession, transport: Transport, topic: str, n: int, **options) -> list[DataFrame]:
    """The ``n`` disjoint parts of a file topic, each as ``read_stream`` with its
    ``share`` reads it; the topic's files are looked at once.  Spark lists them
    for each part, so the parts are made side by side."""
    _check_shares(spark, transport, topic)
    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(lambda k: read_stream(spark, transport, topic, share=(k, n), checked=True, **options),
                             range(n)))


def read_stream(spark: SparkSession, transport: Transport, topic: str, starting=None,
                max_per_trigger: int | None = None, checkpoint: str | None = None,
                share: tuple[int, int] | None = None, checked: bool = False) -> DataFrame:
    """Unbounded read.  Kafka streams start at ``latest`` by default.  A file
    topic streams every file not yet seen by the query's checkpoint;
    ``starting`` (offsets per partition, or ``latest`` with the ``checkpoint`` the
    query will use) leaves earlier messages out.

    ``max_per_trigger`` limits a micro-batch: to so many records on Kafka and on
    a file topic whose transport bounds the records of a file, otherwise to so
    many files.  ``share`` (k, n) reads the k-th of n disjoint parts of a file
    topic, so that n queries read it at the same time, as the consumers of a
    group do; that every file has a share is looked up unless ``checked``."""
    if transport.kind == "kafka":
        if share is not None:
            raise ValueError("consumers of a Kafka topic share its partitions, not files")
        start = starting or "latest"
        r = _kafka_reader(spark.readStream, transport, topic, spark.sparkContext.defaultParallelism).option(
            "startingOffsets", start if isinstance(start, str) else json.dumps(start))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", int(max_per_trigger))
        return r.load()
    if starting == "latest":
        starting = _starting(spark, transport, topic, checkpoint)
    r = spark.readStream.schema(_FILE_SCHEMA)
    if max_per_trigger:
        per_file = int(transport.options.get(RECORDS_PER_FILE, 1))
        r = r.option("maxFilesPerTrigger", max(1, int(max_per_trigger) // per_file))
    if share is not None:
        r = r.option("pathGlobFilter", _share_glob(share))
        if not checked:
            _check_shares(spark, transport, topic)
    env = _with_topic(r.parquet(transport.topic_path(topic)), topic)
    return env if starting in (None, "earliest") else env.where(offset_filter(topic, starting))


# ---------------------------------------------------------------------------
# Payload decode / encode
# ---------------------------------------------------------------------------

def narrow_schema(schema: StructType, fields=None) -> StructType:
    """Keep only the named fields (in schema order).  ``from_json`` then
    materialises just those, which Catalyst does not do by itself once two
    or more fields are read."""
    if fields is None:
        return schema
    wanted = set(fields)
    missing = wanted - set(schema.fieldNames())
    if missing:
        raise ValueError(f"fields not in schema: {sorted(missing)}")
    return StructType([f for f in schema.fields if f.name in wanted])


def decode(env: DataFrame, schema: StructType, fields=None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON ``value`` -> flat typed record.  Malformed JSON gives a row of
    nulls that is kept (PERMISSIVE); a wrong-typed field alone is null.
    ``keep`` carries envelope columns (e.g. partition, offset) along."""
    s = narrow_schema(schema, fields)
    data = F.from_json(F.col("value").cast("string"), s)
    return env.select(*[F.col(k) for k in keep], data.alias("_data")).select(
        *keep, "_data.*")


def decode_supply(env: DataFrame, fields=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON ``value`` -> supply record under its canonical names, whatever
    spelling the producer used (plain, spaced or underscored display names,
    with or without the column family prefix).  Only the wanted fields are
    parsed; a record with a key that looks like another spelling is parsed for
    all of them, and the first that is present counts.  Numbers may come as
    JSON numbers or, there, as text; what is no number is null."""
    wanted = narrow_schema(SUPPLY_SCHEMA, fields)
    names = {f.name: spellings(f.name) for f in wanted}
    wire = StructType([StructField(s, StringType()) for own in names.values() for s in own])
    # Some spellings differ in case only, which column resolution would not
    # tell apart: the parsed struct's fields are renamed by position.
    place = {s: f"_{k}" for k, s in enumerate(wire.fieldNames())}
    plain = StructType([StructField(place[s], StringType()) for s in wire.fieldNames()])
    text, is_spelled = F.col("_text"), F.col("_is_spelled")
    spelled = F.when(is_spelled, F.from_json(text, wire).cast(plain))
    canonical = F.when(~is_spelled, F.from_json(text, wanted))

    def value(f):
        found = F.coalesce(*[F.col("_spelled")[place[s]] for s in names[f.name]])
        found = try_double(found) if isinstance(f.dataType, DoubleType) else found
        return F.coalesce(F.col("_data")[f.name], found).alias(f.name)
    tested = env.select(*[F.col(k) for k in keep], F.col("value").cast("string").alias("_text")).select(
        *keep, "_text", F.col("_text").rlike(_SPELLED_KEY).alias("_is_spelled"))       # one test per record
    return tested.select(*keep, canonical.alias("_data"), spelled.alias("_spelled")).select(
        *keep, *[value(f) for f in wanted])


# A JSON key with the column family prefix or an upper-case first letter.  The
# quantifier is possessive: a value that starts like such a key is left at once.
_SPELLED_KEY = '"(?:cf1:|[A-Z])[^"]*+"\\s*:'


def encode(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Record -> envelope payload: ``value`` = JSON of all columns (null
    fields are omitted, as ``to_json`` does), ``key`` null unless given."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    k = key.cast("binary") if key is not None else F.lit(None).cast("binary")
    return df.select(k.alias("key"), value.cast("binary").alias("value"))


def cast_transactions(df: DataFrame) -> DataFrame:
    """The six numeric transaction fields, cast without ever failing:
    doubles by ``try_cast``, ints with the legacy truncating rule."""
    out = []
    for c in df.columns:
        if c in TRANSACTION_DOUBLES:
            out.append(try_double(c).alias(c))
        elif c in TRANSACTION_INTS:
            out.append(try_int_legacy(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def decode_transactions(env: DataFrame, fields=None, keep=()) -> DataFrame:
    """Envelope -> typed transaction records (decode + the six casts)."""
    return cast_transactions(decode(env, TRANSACTION_WIRE_SCHEMA, fields, keep))


def preview(env: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` messages in (partition, offset) order: a top-n sort
    (TakeOrderedAndProject) that keeps n rows per task, never the topic."""
    return env.orderBy("partition", "offset").limit(n)


def compacted(env: DataFrame, key: Column) -> DataFrame:
    """Newest message per key, as a log-compacted topic would keep it.  The
    publisher gives all messages of a key the same message key, so they lie in
    one partition and their offsets order them.  One aggregate (``max_by``
    value by (offset, partition)) whose partial phase
    collapses a hot key inside each task.  Republished reports (streaming
    complete mode, reruns) read back as their current value."""
    return (env.groupBy(key.alias("_key"))
               .agg(F.max_by("value", F.struct("offset", "partition")).alias("value"))
               .select("value"))
