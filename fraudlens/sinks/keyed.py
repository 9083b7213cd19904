"""Keyed puts into a wide-column style table (latest wins).

A put is a write of the data source ``keyed_puts`` under Spark's own write
protocol: every task writes its rows as one Parquet file, ``commit`` names the
files of the successful attempts in one small marker, ``abort`` removes the
folder.  A put without its marker does not exist for readers, so a failed task
or job leaves nothing, and no writer ever waits for, checks or overwrites
another: puts only add.

As in a wide-column store, rows carry their version, and reading decides: the
newest row of a key is the largest by the table's order columns (normally
timestamp, partition, offset of the message), then by the time of the put.
Since the largest of a set does not depend on the order in which its parts
arrive, concurrent writers, replays and repeated loads need no coordination.
A put replaces the columns it carries in the row of its key; columns it does
not carry keep their value.

``compact`` writes the newest rows as one more put and then removes the puts it
read; a reader that meets both sees the same rows.

Key and order belong to the table (``_table.json``); a put that names others is
refused.  Rows with a null key are rejected and counted, by ``observe`` on the
write itself.  Files are written by pyarrow, so the table's file system must be
one that pyarrow reaches from the executors (a shared mount, HDFS, S3, GCS).
"""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from fraudlens.folder import Folder
from fraudlens.plans.joins import join_dimension
from fraudlens.session import cut_lineage

FORMAT, MARKER, TABLE, PUT = "keyed_puts", "_committed.json", "_table.json", "_put"
NARROW = 12                      # rows of at most so many columns are ranked as a whole


@dataclass
class UpsertResult:
    rows_in: int
    rejected_null_keys: int


def put_source():
    """The data source class.  It is made in a function so that it travels to
    the executors by value: they need pyarrow, not this package."""
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    class PutWriter(DataSourceArrowWriter):
        def __init__(self, path: str, marker: str):
            self.path, self.marker = path, marker

        def _store(self):
            from pyarrow import fs
            if self.path.startswith("file:"):
                return fs.LocalFileSystem(), "/" + self.path[5:].lstrip("/")
            return fs.FileSystem.from_uri(self.path)

        def write(self, iterator):
            import pyarrow.parquet as pq
            from pyspark import TaskContext
            task, out = TaskContext.get(), None
            store, folder = self._store()
            done = WriterCommitMessage()
            done.file, done.rows = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.parquet", 0
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    store.create_dir(folder)
                    out = pq.ParquetWriter(f"{folder}/{done.file}", batch.schema, filesystem=store, compression="zstd")
                out.write_batch(batch)
                done.rows += batch.num_rows
            if out is not None:
                out.close()
            return done

        def commit(self, messages):
            import json
            store, folder = self._store()
            files = [m.file for m in messages if m is not None and m.rows]
            if files:
                with store.open_output_stream(f"{folder}/{self.marker}") as out:
                    out.write(json.dumps({"files": files}).encode())

        def abort(self, messages):
            from pyarrow import fs
            store, folder = self._store()
            if store.get_file_info(folder).type != fs.FileType.NotFound:
                store.delete_dir(folder)

    class KeyedPuts(DataSource):
        @classmethod
        def name(cls):
            return "keyed_puts"

        def writer(self, schema, overwrite):
            return PutWriter(self.options["path"], self.options["marker"])

    return KeyedPuts


_registered: set[str] = set()
_registering = threading.Lock()


def register(spark: SparkSession) -> None:
    """Make ``keyed_puts`` known to the session, once: registering anew would
    take the name away for a moment, also from a writer in another thread."""
    with _registering:
        own = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"
        if own not in _registered:
            spark.dataSource.register(put_source())
            _registered.add(own)
    # The source is looked up in the thread's active session, which other threads than the first lack.
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)


def _absolute(path: str) -> str:
    return path if ":" in path.split("/")[0] else "file:" + path


def _write_put(rows: DataFrame, folder: Folder, at: int) -> str:
    """One put with the version ``at``; its folder name tells the columns."""
    register(rows.sparkSession)
    columns = uuid.uuid5(uuid.NAMESPACE_OID, "\0".join(sorted(rows.columns))).hex[:12]
    name = f"put-{columns}-{at:020d}-{uuid.uuid4().hex[:12]}"
    rows.write.format(FORMAT).mode("append").option("marker", MARKER).save(_absolute(f"{folder.path}/{name}"))
    return name


def _puts(folder: Folder) -> list[str]:
    return [n for n in folder.names() if n.startswith("put-") and folder.exists(f"{n}/{MARKER}")]


def upsert(spark: SparkSession, updates: DataFrame, table_path: str, key: str,
           order_cols: list[str] | None = None) -> UpsertResult:
    """Put all rows of ``updates``.  Without ``order_cols`` the later put wins;
    within one put a key then has one row, or any of its rows wins."""
    folder, table = Folder(spark, table_path), {"key": key, "order": list(order_cols or [])}
    if folder.exists(TABLE):
        for what, value in folder.read(TABLE).items():
            if table[what] != value:
                raise ValueError(f"{table_path}: the table has {what}={value!r}, not {table[what]!r}")
    else:
        folder.write(TABLE, table)               # first writers at the same time write the same
    latest = max((int(n.split("-")[2]) for n in _puts(folder)), default=0)
    at = max(int(time.time() * 1e6), latest + 1)
    counted = Observation()
    rows = updates.observe(counted, F.count(F.lit(1)).alias("rows_in"),
                           F.count(F.when(F.col(key).isNull(), 1)).alias("rejected"))
    _write_put(rows.where(F.col(key).isNotNull()).withColumn(PUT, F.lit(at)), folder, at)
    return UpsertResult(counted.get["rows_in"], counted.get["rejected"])


def _by_columns(spark: SparkSession, folder: Folder, puts: list[str]) -> list[DataFrame]:
    """All rows of the puts, one frame per set of columns."""
    sets: dict[str, list[str]] = {}
    for n in puts:
        own = [f"{folder.path}/{n}/{f}" for f in folder.read(f"{n}/{MARKER}")["files"]]
        sets.setdefault(n.split("-")[1], []).extend(own)
    return [spark.read.parquet(*files) for files in sets.values()]


def _newest(rows: DataFrame, table: dict) -> DataFrame:
    """The newest row per key.  The rank limit is applied in the map tasks
    too, so a key with many versions is reduced before the exchange."""
    version = [F.col(c).desc_nulls_last() for c in (*table["order"], PUT)]
    rank = F.row_number().over(Window.partitionBy(table["key"]).orderBy(*version))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _newest_wide(rows: DataFrame, table: dict) -> DataFrame:
    """``_newest`` for rows of many columns in the files of puts.  Keys and
    versions alone are ranked, with each row's place (its file and number); the
    places of the newest rows become bitmaps, an eighth of a byte per row, and
    a second read keeps the rows whose bit is set.  While the bitmaps are small
    enough to broadcast, whole rows are neither exchanged nor sorted."""
    if len(rows.columns) <= NARROW:
        return _newest(rows, table)
    path, number = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    if rows.select(path.alias("p")).distinct().groupBy(F.xxhash64("p")).count().where("count > 1").count():
        return _newest(rows, table)              # a file is told by the hash of its path
    places = _newest(rows.select(table["key"], *table["order"], PUT, F.xxhash64(path).alias("_file"),
                                 number.alias("_row")), table)
    bits = cut_lineage(places.groupBy("_file", F.bitmap_bucket_number("_row").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits")))
    placed = rows.select("*", F.xxhash64(path).alias("_of"), F.bitmap_bucket_number(number).alias("_in"),
                         F.bitmap_bit_position(number).cast("int").alias("_bit"))
    met = join_dimension(placed, bits, (F.col("_of") == F.col("_file")) & (F.col("_in") == F.col("_bucket")))
    byte = F.conv(F.hex(F.expr("substring(_bits, _bit div 8 + 1, 1)")), 16, 10).cast("int").alias("_byte")
    return met.select(*rows.columns, "_bit", byte).where("shiftright(_byte, _bit % 8) % 2 = 1").select(*rows.columns)


def _merged(frames: list[DataFrame], table: dict, newest=_newest_wide) -> DataFrame:
    """One row per key: each column from the newest put that carries it."""
    if len(frames) == 1:
        return newest(frames[0], table)
    key, order = table["key"], [*table["order"], PUT]
    columns = list(dict.fromkeys(c for f in frames for c in f.columns if c not in (key, *order)))
    holders: dict[tuple, list[str]] = {}         # columns that the same frames carry
    for c in columns:
        holders.setdefault(tuple(k for k, f in enumerate(frames) if c in f.columns), []).append(c)
    rows = None
    for k, frame in enumerate(frames):
        frame = newest(frame, table).withColumn("_set", F.lit(k))
        rows = frame if rows is None else rows.unionByName(frame, allowMissingColumns=True)
    at = F.struct(*order)
    values = [F.max(at).alias("_at"), *[
        F.max_by(F.struct(*own), F.when(F.col("_set").isin(list(sets)), at)).alias(f"_g{k}")
        for k, (sets, own) in enumerate(holders.items())]]
    one = rows.groupBy(key).agg(*values)
    return one.select(key, *[F.col("_at")[c].alias(c) for c in order],
                      *[F.col(f"_g{k}")[c].alias(c) for k, own in enumerate(holders.values()) for c in own])


def _state(spark: SparkSession, table_path: str) -> tuple[Folder, dict, list[str]]:
    folder = Folder(spark, table_path)
    if not folder.exists(TABLE) or not (puts := _puts(folder)):
        raise FileNotFoundError(f"nothing was put into {table_path}")
    return folder, folder.read(TABLE), puts


def read_table(spark: SparkSession, table_path: str, keys_like: list | None = None) -> DataFrame:
    """The table's current rows; with ``keys_like`` those keys' only, a filter
    that reaches the scan of every put."""
    folder, table, puts = _state(spark, table_path)
    frames = _by_columns(spark, folder, puts)
    if keys_like is not None:
        frames = [f.where(F.col(table["key"]).isin(list(keys_like))) for f in frames]
    return _merged(frames, table, _newest_wide if keys_like is None else _newest).drop(PUT)


def compact(spark: SparkSession, table_path: str) -> None:
    """Merge the puts of every set of columns into one.  The merged rows keep
    their versions, so a put that arrives meanwhile is neither lost nor hidden."""
    folder, table, puts = _state(spark, table_path)
    sets: dict[str, list[str]] = {}
    for n in puts:
        sets.setdefault(n.split("-")[1], []).append(n)
    for own in sets.values():
        if len(own) < 2:
            continue
        rows = _newest_wide(_by_columns(spark, folder, own)[0], table)
        _write_put(rows, folder, max(int(n.split("-")[2]) for n in own))
        for n in own:
            folder.delete(n)
