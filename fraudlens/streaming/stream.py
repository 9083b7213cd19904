"""Structured Streaming forms of the pipeline.

* ``raw_values`` / ``decoded``: stateless projections, append mode.
* ``running_report``: a report spec as a stateful streaming aggregate
  (complete or update mode).  State holds one row per key.  Complete mode
  hands the whole state on after every micro-batch, so it is refused for
  reports whose key domain grows with the data (``UNBOUNDED_KEYS``); update
  mode, which hands on the changed rows only, takes any report.
* ``fan_out``: many reports from one stream: the fused grouping-sets
  aggregate is the single stateful operator, and ``foreachBatch`` slices and
  publishes every report per micro-batch.

Every query gets a checkpoint folder under the shared checkpoint location,
so a restart resumes where it stopped and does not re-read processed input.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from py4j.java_gateway import JavaClass
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fraudlens.folder import Folder
from fraudlens.operators import fused
from fraudlens.operators.reports import REPORTS, ReportSpec, run_report
from fraudlens.session import shared_dir

# Key columns whose domain grows with the data: no complete mode.
UNBOUNDED_KEYS = {"user_income", "project_code", "transaction_id", "pq"}

STATE_PARTITIONS = 4             # state stores of reports with few keys
_PARTITIONS = "spark.sql.shuffle.partitions"
_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_REWRITE = "spark.sql.streaming.fileSource.log.compactInterval"
_starting = threading.Lock()


def raw_values(env: DataFrame) -> DataFrame:
    """Message payload as text with its position (STR-1)."""
    return env.select("topic", "partition", "offset",
                      F.col("value").cast("string").alias("value"))


def running_report(records: DataFrame, spec: ReportSpec | str) -> DataFrame:
    spec = REPORTS[spec] if isinstance(spec, str) else spec
    return run_report(spec, records)


def _bounded(keys, mode: str) -> None:
    """Refuse complete mode for keys whose domain grows with the data."""
    unbounded = sorted(set(keys) & UNBOUNDED_KEYS)
    if mode == "complete" and unbounded:
        raise ValueError(f"key {unbounded[0]!r} is unbounded: every micro-batch would hand on a state "
                         "that grows with the data; use update mode")


def _start_bounded(writer, spark: SparkSession) -> StreamingQuery:
    """Start a query whose state is a few rows, in ``STATE_PARTITIONS`` state
    stores: every micro-batch writes a file per store, whatever it holds.  A
    query takes its settings when it starts, and a checkpoint keeps them."""
    few = min(STATE_PARTITIONS, int(spark.conf.get(_PARTITIONS, None) or STATE_PARTITIONS))
    with _starting, _settings(spark, {_PARTITIONS: str(few)}):
        return writer.start()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def light_logs(spark: SparkSession, *paths: str, rewrite_every: int | None = None):
    """Queries that start and run in here write the logs of their micro-batches
    under ``paths`` with less work, for very many small ones.

    Without Hadoop's native library, the manager of logs that Spark takes by
    itself starts a process for each path of a rename on a local file system,
    only to ask whether it is a link.  Its other manager renames there as well,
    and asks nothing; the logs are the same.  On other file systems, and where
    the session names a manager, that one stays.

    A query rewrites its log of the files it has read as a whole every 10
    batches, which grows with the square of their number.  ``rewrite_every``
    names another number; a restart of the query needs the same one."""
    manager = spark.sparkContext._jvm.org.apache.spark.sql.execution.streaming.checkpointing \
        .FileSystemBasedCheckpointFileManager
    other = (isinstance(manager, JavaClass) and spark.conf.get(_MANAGER, None) is None
             and all(Folder(spark, p).is_local for p in paths))
    rewrite = {_REWRITE: str(rewrite_every)} if rewrite_every else {}
    with _settings(spark, rewrite | ({_MANAGER: manager._fqn} if other else {})):
        yield


def _writer(df: DataFrame, checkpoint: str, mode: str, trigger: dict | None):
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True}))


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
             trigger: dict | None = None) -> StreamingQuery:
    """Append-mode file sink (exactly-once through the sink's own log)."""
    return _writer(df, checkpoint, "append", trigger).format(fmt).start(path)


def to_table_snapshot(df: DataFrame, path: str, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """Complete-mode aggregate; each micro-batch replaces the snapshot at
    ``path`` (the result is small: one row per key)."""
    _bounded(df.columns, "complete")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(path)
    return _start_bounded(_writer(df, checkpoint, "complete", trigger).foreachBatch(write), df.sparkSession)


def to_console(df: DataFrame, mode: str = "append", trigger: dict | None = None,
               checkpoint: str | None = None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).format("console")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def fan_out(records: DataFrame, names, sink, checkpoint: str,
            trigger: dict | None = None) -> StreamingQuery:
    """One stateful query serving a whole report set.  ``sink(epoch,
    {name: DataFrame})`` receives the full current value of every report
    after each micro-batch (complete mode): few rows, brought into one
    partition, since the slices of all reports read every partition."""
    names = list(names)
    _bounded([REPORTS[n].key for n in names], "complete")
    agg = fused.fused_aggregate(records, names)

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.repartition(1).persist()
        try:
            sink(epoch, fused.split_fused(batch, names))
        finally:
            batch.unpersist()
    return _start_bounded(_writer(agg, checkpoint, "complete", trigger).foreachBatch(write), records.sparkSession)


def run_to_end(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow query, without limit unless one is given;
    raise if it failed or did not finish."""
    finished = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination(), True)[1]
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_all_to_end(queries) -> None:
    """Wait for several availableNow queries; when one has failed, the others
    are stopped and its error is raised."""
    queries = list(queries)
    try:
        for q in queries:
            run_to_end(q)
    except BaseException:
        for q in queries:
            q.stop()
        raise


def counted(df: DataFrame, name: str, **columns) -> DataFrame:
    """``df`` whose rows and non-null values of the named columns are counted
    while they pass (``alias="column"``); no second pass, no state."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      *[F.count(c).alias(alias) for alias, c in columns.items()])


def observed_totals(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums of a ``counted`` metric over the query's reported micro-batches
    (Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates``)."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress["observedMetrics"].get(name)
        for k, v in (row.asDict() if hasattr(row, "asDict") else row or {}).items():
            totals[k] = totals.get(k, 0) + v
    return totals


def batch_sizes(query: StreamingQuery) -> list[int]:
    """Input rows of the reported micro-batches that had any."""
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def checkpoint_dir(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"stream-{name}")


def to_topic(df: DataFrame, transport, topic: str, checkpoint: str, mode: str = "append",
             trigger: dict | None = None, key_col: str | None = None) -> StreamingQuery:
    """Publish a streaming DataFrame as JSON messages.  Kafka: the native
    streaming sink; file transport: each micro-batch is published by
    ``foreachBatch`` (complete mode republishes the full current result).  A
    micro-batch that is replayed after a failure is published again: at least
    once, as the native sink."""
    from fraudlens.sinks.publish import publish
    from fraudlens.sources.envelope import encode
    _bounded(df.columns if mode == "complete" else (), mode)
    if transport.kind == "kafka":
        enc = encode(df).select("key", "value")
        w = (_writer(enc, checkpoint, mode, trigger).format("kafka")
             .option("kafka.bootstrap.servers", transport.bootstrap_servers)
             .option("topic", topic))
        for k, v in transport.options.items():
            w = w.option(k, v)
        return w.start()
    spark = df.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        publish(spark, batch, transport, topic, key_col=key_col)
    w = _writer(df, checkpoint, mode, trigger).foreachBatch(write)
    return _start_bounded(w, spark) if mode == "complete" else w.start()


def to_keyed_table(df: DataFrame, spec: ReportSpec | str, table_path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Update mode: each micro-batch emits only the keys whose aggregate
    changed, and ``foreachBatch`` upserts them into the keyed table (row key as
    in ``report_row_key``; the later put wins, so a new run with a fresh
    checkpoint replaces what an older one left).  A replayed micro-batch puts the
    same rows again, which changes nothing."""
    from fraudlens.plans.jobs import report_row_key
    from fraudlens.sinks.keyed import upsert
    spec = REPORTS[spec] if isinstance(spec, str) else spec
    spark = df.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(report_row_key(spec.name, spec.key).alias("_row_key"), *batch.columns)
        upsert(spark, rows, table_path, "_row_key")
    w = _writer(df, checkpoint, "update", trigger).foreachBatch(write)
    return w.start() if spec.key in UNBOUNDED_KEYS else _start_bounded(w, spark)
