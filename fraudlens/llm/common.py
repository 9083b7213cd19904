"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.session import cut_lineage, ensure_checkpoint_dir, shared_dir  # noqa: F401

TEXT = "__text"
BITMAP_BITS = 25
PART_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: a lineage cut that survives lost executors and is column-pruned by
    its readers."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    """True for the rows that no model may learn from: crc32 of the id's
    decimal text leaves the remainder 1 by 3.  A null id counts as its empty
    text, so the flag is never null."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def arrow_type(dt: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this library importable on the executors (once per application):
    the workers' caches live in its modules, so they are imported there and
    not pickled."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="fraudlens-code-"), "fraudlens.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Return memory that a finished task has freed to the system.  A worker
    serves one operator after another, and what its allocators keep for later adds
    to the next one's need."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):        # not glibc
        return


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this library on the executors."""
    def run(batches):
        yield from fn(batches)
        give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def maybe_in(rows: DataFrame, id_col: str, ids: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose id may be among ``ids`` (one long column), or with
    ``inside=False`` those whose id certainly is not.  No row is shuffled: the
    ids become a bitmap of their hashes, 16 bits for each and at most
    ``BITMAP_BITS`` (8 MB as a broadcast table of words), so that an exact join
    behind it moves little more than it keeps.  With more ids the bitmap fills
    up and filters less; results never change."""
    (name,) = ids.columns
    n = ids.count()
    bits = 1 << max(16, min(BITMAP_BITS, (16 * n).bit_length()))

    def place(c):
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(bits))

    words = ids.select(place(ids[name]).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    at = place(rows[id_col])
    own = rows.select(F.struct(*rows.columns).alias("row"), F.shiftright(at, 6).alias("word"),
                      at.bitwiseAND(63).cast("int").alias("bit"))
    found = own.join(F.broadcast(words), "word", "left").withColumn(
        "hit", F.coalesce(F.expr("(shiftright(bits, bit) & 1) = 1"), F.lit(False)))
    return found.where("hit" if inside else "not hit").select("row.*")


def parts_of(batches):
    """The batches in parts of at most ``PART_ROWS`` rows, so that a worker
    holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(start, PART_ROWS)


def map_text(docs: DataFrame, fn, outputs: str, text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """Append columns that ``fn(list of texts)`` computes batch by batch.

    ``fn`` gets the texts of one Arrow batch (null as ``None``) and returns
    one sequence per output column.  ``outputs`` is a DDL schema.  An input
    column with the name of an output is replaced by the output.
    """
    out_schema = T.StructType.fromDDL(outputs)
    names = set(out_schema.names)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*[docs[c] for c in keep], docs[text_col].alias(TEXT))
    schema = T.StructType([source.schema[c] for c in keep] + list(out_schema))
    types = [arrow_type(f.dataType) for f in out_schema]
    all_names = schema.names
    n_keep = len(keep)

    def run(batches):
        for batch in parts_of(batches):
            made = fn(batch.column(n_keep).to_pylist())
            arrays = [batch.column(i) for i in range(n_keep)]
            arrays += [pa.array(v, type=t) for v, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=all_names)

    return arrow_map(source, run, schema)
