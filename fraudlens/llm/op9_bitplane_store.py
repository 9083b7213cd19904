"""Token-id output in bit planes.

Documents are put in ascending id order by a range exchange, encoded, and
their ids (with an end id after each) written as shards, one per partition.
A shard is a sequence of blocks of ``BLOCK_IDS`` ids; a block's ids are
transposed into bit planes (plane k holds bit k of every id) or byte planes,
and each plane is compressed by zstandard on its own, so that the almost
constant high planes take no room.  The chunk index holds for every block its
place in the shard, its number of ids, the first and last documents in it and
the compressed length of each plane.

Format (a Parquet folder, so that any file system Spark writes to will do and
a lost executor's half-written files are never seen):
  shard, block     place in id order
  first_id, n_ids  position in the shard, ids in the block
  planes           the non-zero planes' zstandard frames one after another
  plane_bytes      length of each frame, lowest plane first; 0 for a zero plane
  docs, ends       ids of the documents that end in the block, and where
``read_documents`` decodes blocks independently of each other; a document
that spans blocks is put together from the checksums of its parts.

Memory is bounded by a block and one document's text.

Defined cases: null and empty texts hold the end id only; a null document id
sorts first; repeated ids are ordered by their text; texts of any length are
written whole; an empty table writes no block; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import bpe
from fraudlens.llm.common import arrow_map, shared_dir, staged, table

BLOCK_IDS = 1 << 18
BLOCKS = ("shard int, block long, first_id long, n_ids int, planes binary, plane_bytes array<int>, "
          "docs array<long>, ends array<int>")
LEVEL = 1


# -- planes -------------------------------------------------------------------
_STEPS = [(np.uint64(shift), np.uint64(mask)) for shift, mask in
          ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0))]


def transposed(column: np.ndarray) -> np.ndarray:
    """(bytes, 8) bit matrix of a byte column: byte j of row g holds bit j of
    the column's bytes 8g to 8g + 7.  Its own inverse on flat arrays."""
    x = np.ascontiguousarray(column).view("<u8").copy()
    for shift, mask in _STEPS:                       # swap ever larger blocks of an 8 x 8 bit square
        t = (x ^ (x >> shift)) & mask
        x ^= t ^ (t << shift)
    return x.view(np.uint8).reshape(-1, 8)


def to_planes(ids: np.ndarray, unit: int = 1) -> list[bytes]:
    """Planes of ``unit`` bits (1 or 8) of uint32 ids, lowest first, without
    the zero planes at the top."""
    ids = np.concatenate([np.asarray(ids, dtype="<u4"), np.zeros(-len(ids) % 8 if unit == 1 else 0, "<u4")])
    used = (int(ids.max()).bit_length() if len(ids) else 0) + 7 >> 3
    columns = [((ids >> np.uint32(8 * k)) & np.uint32(255)).astype(np.uint8) for k in range(used)]
    if unit == 8:
        return [c.tobytes() for c in columns]
    planes = [m[:, j].tobytes() for m in map(transposed, columns) for j in range(8)]
    while planes and not any(planes[-1]):
        planes.pop()
    return planes


def from_planes(planes: list[bytes], n: int, unit: int = 1) -> np.ndarray:
    ids = np.zeros(n, dtype="<u4")
    step = 1 if unit == 8 else 8
    for k in range(0, len(planes), step):
        if unit == 8:
            column = np.frombuffer(planes[k], np.uint8)
        else:
            m = np.zeros((-(-n // 8), 8), dtype=np.uint8)
            for j, p in enumerate(planes[k:k + 8]):
                m[:, j] = np.frombuffer(p, np.uint8)
            column = transposed(m.ravel()).ravel()[:n]
        ids |= column.astype("<u4") << np.uint32(8 * (k // step))
    return ids


def pack(ids: np.ndarray, unit: int = 1) -> tuple[bytes, list[int]]:
    import zstandard
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    frames = [compress(p) if any(p) else b"" for p in to_planes(ids, unit)]
    return b"".join(frames), [len(f) for f in frames]


def unpack(data: bytes, lengths: list[int], n: int, unit: int = 1) -> np.ndarray:
    import zstandard
    decompress = zstandard.ZstdDecompressor().decompress
    size, planes, at = n if unit == 8 else (n + 7) // 8, [], 0
    for length in lengths:
        planes.append(decompress(data[at:at + length]) if length else bytes(size))
        at += length
    return from_planes(planes, n, unit)


# -- writing ------------------------------------------------------------------
def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = 0, unit: int = 1,
                 block_ids: int = BLOCK_IDS) -> None:
    """Write the token ids of all documents in ascending id order."""
    file = tokenizer or bpe.default_path()
    end = end_id.to_bytes(4, "little")

    def blocks(batches):
        from pyspark import TaskContext
        shard, enc = TaskContext.get().partitionId(), bpe.encoder(file)
        parts, held, docs_held, ends, block = [], 0, [], [], 0

        def made(data: bytes):
            ids = np.frombuffer(data, "<u4")
            planes, lengths = pack(ids, unit)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int64()),
                 pa.array([block * block_ids], pa.int64()), pa.array([len(ids)], pa.int32()),
                 pa.array([planes], pa.binary()), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([docs_held], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int32()))],
                names=["shard", "block", "first_id", "n_ids", "planes", "plane_bytes", "docs", "ends"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw, at = enc.encode(text.as_py() or "") + end, 0
                while held + (len(raw) - at) // 4 >= block_ids:
                    take = (block_ids - held) * 4
                    parts.append(raw[at:at + take])
                    at += take
                    if at == len(raw):
                        docs_held.append(doc)
                        ends.append(block_ids)
                    yield made(b"".join(parts))
                    parts, held, docs_held, ends, block = [], 0, [], [], block + 1
                if at < len(raw):
                    parts.append(raw[at:])
                    held += (len(raw) - at) // 4
                    docs_held.append(doc)
                    ends.append(held)
        if held:
            yield made(b"".join(parts))

    source = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text"))
    ordered = source.repartitionByRange("doc").sortWithinPartitions("doc", "text")
    arrow_map(ordered, blocks, BLOCKS).write.option("compression", "none").parquet(path)


# -- reading ------------------------------------------------------------------
def _times(matrix: list[int], vector: int) -> int:
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


@lru_cache(maxsize=64)
def _zeros(power: int) -> tuple[int, ...]:
    """The linear map of a crc32 register over 2 ** power zero bytes."""
    if power:
        half = _zeros(power - 1)
        return tuple(_times(half, _times(half, 1 << k)) for k in range(32))
    shift = [0xEDB88320] + [1 << k for k in range(31)]        # one zero bit
    for _ in range(3):
        shift = [_times(shift, _times(shift, 1 << k)) for k in range(32)]
    return tuple(shift)


def crc_join(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings put together, from their crc32s."""
    power = 0
    while second_bytes:
        if second_bytes & 1:
            first = _times(_zeros(power), first)
        second_bytes >>= 1
        power += 1
    return first ^ second


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.sql import types as T
    return spark.read.schema(T.StructType.fromDDL(BLOCKS)).parquet(path)


def read_documents(spark: SparkSession, path: str, unit: int = 1, ids: bool = False) -> DataFrame:
    """One row per document: shard, doc, at (position of its first id in the
    shard), n_tokens, ids_crc32 and, if wanted, its ids."""
    schema = "shard int, doc long, at long, ended boolean, n_tokens long, crc long" + ", ids array<long>" * ids

    def parts(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = unpack(row["planes"], row["plane_bytes"], row["n_ids"], unit)
                cuts, docs_here = row["ends"], row["docs"]
                ended = [True] * len(cuts)
                if not cuts or cuts[-1] < row["n_ids"]:        # the last document goes on
                    cuts, docs_here, ended = cuts + [row["n_ids"]], docs_here + [None], ended + [False]
                starts = [0] + cuts[:-1]
                pieces = [own[a:b] for a, b in zip(starts, cuts)]
                arrays = [pa.array([row["shard"]] * len(cuts), pa.int32()), pa.array(docs_here, pa.int64()),
                          pa.array([row["first_id"] + a for a in starts], pa.int64()),
                          pa.array(ended), pa.array([len(p) for p in pieces], pa.int64()),
                          pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64())]
                names = ["shard", "doc", "at", "ended", "n_tokens", "crc"]
                if ids:
                    arrays.append(pa.array([p.tolist() for p in pieces], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    blocks = read_blocks(spark, path)
    # Whether a part begins a document: it does at the block's start only if
    # the block before ended there, which the index says.
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1)).otherwise(0) < F.col("n_ids")
    open_ends = blocks.where(last).select("shard", (F.col("first_id") + F.col("n_ids")).alias("at"))
    found = arrow_map(blocks.select(*[c.split()[0] for c in BLOCKS.split(", ")]), parts, schema)
    marked = found.join(open_ends.withColumn("goes_on", F.lit(True)), ["shard", "at"], "left")
    if not ids:                                   # a few numbers per part: decode once for both branches
        marked = staged(marked, "token-parts")
    whole = marked.where("ended and goes_on is null")
    columns = ["shard", "doc", "at", "n_tokens", F.col("crc").alias("ids_crc32"), *["ids"] * ids]
    return whole.select(*columns).unionByName(_spanning(marked, ids).select(*columns))


def _spanning(marked: DataFrame, ids: bool) -> DataFrame:
    """Documents of several blocks, from their parts (a few per block)."""
    from pyspark.sql import Window
    parts = marked.where("not ended or goes_on")
    order = Window.partitionBy("shard").orderBy("at")
    numbered = parts.withColumn("nth", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(order))

    @F.udf("long")
    def joined(pieces):
        crc = 0
        for p in pieces:
            crc = crc_join(crc, p["crc"], p["n_tokens"] * 4)
        return crc

    value = F.struct("at", "n_tokens", "crc", "doc", *["ids"] * ids)
    whole = numbered.groupBy("shard", "nth").agg(F.sort_array(F.collect_list(value)).alias("pieces"))
    out = whole.select("shard", F.element_at("pieces", -1)["doc"].alias("doc"), F.col("pieces")[0]["at"].alias("at"),
                       F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["n_tokens"]).alias("n_tokens"),
                       joined("pieces").alias("crc"), *([F.flatten(F.col("pieces.ids")).alias("ids")] if ids else []))
    return out


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, start): ids in all shards before; one row per shard."""
    from pyspark.sql import Window
    sizes = read_blocks(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def read_index(spark: SparkSession, path: str, unit: int = 1, ids: bool = False) -> DataFrame:
    """doc, start (ids of all documents before it), n_tokens, ids_crc32."""
    starts = staged(shard_starts(spark, path), "shard-starts")
    return read_documents(spark, path, unit, ids).join(starts, "shard").select(
        "doc", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def query(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-planes")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_index(spark, path).withColumnRenamed("doc", "doc_id")
