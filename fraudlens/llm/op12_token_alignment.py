"""Alignment of two tokenizers by diagonal run skipping.

Both tokenizers cut the same bytes (a space and the text).  Their tokens are
compared by the byte offsets at which they end: as long as token ``i`` of A
and token ``i + shift`` of B end together, the tokens are one-to-one.
Exponential probing compares slices of both end arrays at the current shift
and jumps over such stretches; where the ends differ, the side that is behind
moves on until both meet again, which makes one irregular group and the new shift.

A link is a pair of tokens that end together (the last tokens of a group).
Link counts over the whole corpus are summed per task and then per pair of ids.
They come back to the documents on two tiers: the counts of at most
``TABLE_LINKS`` frequent pairs are broadcast (a count threshold chosen from the
histogram of counts by powers of two), the other links of a document are joined
with the counts.  The highest count of each B id has at most one row per piece of
the model and is broadcast.

The groups of a text are computed once; its distinct links with their
multiplicity are staged in the shared folder.  Memory is bounded by one part of
texts with their tokens.

Defined cases: a null or empty text, and one whose tokens of either side do
not give the text's bytes back (U+2581 in the text, say), has no tokens:
zeros and an empty string; special strings inside texts are plain text; texts of any length
are encoded whole; repeated rows (and null ids) are rows of their own, and each
counts; an empty table gives an empty result; an input column named like an
output is replaced.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm import bpe
from fraudlens.llm.common import arrow_map, map_text, parts_of, shared_dir, staged, table

TABLE_LINKS = 1 << 19        # pairs of ids whose counts are broadcast (17 bytes each)
TASK_LINKS = 1 << 21         # pairs that a task sums up before it sends them on
OUTPUTS = {"n_a": "long", "n_b": "long", "n_groups": "long", "groups": "string", "groups_sha256": "string",
           "links": "binary", "link_times": "binary"}
QUERY_OUTPUTS = ("n_a", "n_b", "n_groups", "groups_sha256", "links", "link_times")
ROW = "__row"
UNITS = 300_000              # units of the piece model that a generation of its cache holds
PROBE = 4                    # tokens of the first comparison of a stretch
_UNIT = re.compile(" +[^ ]+| +")


# -- tokenizers ---------------------------------------------------------------
class PieceEncoder:
    """Worker-side encoder for a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        self.token_bytes = [self._bytes(i) for i in range(size)]
        self.sizes = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.digits = [str(i) for i in range(size)]
        # No piece holds a space behind another character: then no merge reaches
        # from one unit (spaces and what follows them) into the next, and units are encoded once each.
        self.by_unit = not any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(size))
        self.ids_of, self.older = {}, {}             # two generations of at most UNITS entries

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def _learn(self, units: set[str]) -> None:
        """Ids of units that the cache lacks; the model adds a unit's first space itself."""
        for unit in [u for u in units if u in self.older]:
            self.ids_of[unit] = self.older[unit]
            units.discard(unit)
        blank = array("I", [self.model.piece_to_id("▁")]).tobytes()
        units = list(units)
        for unit, ids in zip(units, self.model.encode([u[1:] for u in units], num_threads=1)):
            self.ids_of[unit] = array("I", ids).tobytes() if len(unit) > 1 else blank

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_unit:
            return [np.array(ids, dtype="<u4") for ids in self.model.encode(texts, num_threads=1)]
        cut = [_UNIT.findall(" " + t.replace("▁", " ")) if t else [] for t in texts]
        if len(self.ids_of) > UNITS:
            self.ids_of, self.older = {}, self.ids_of
        self._learn(set().union(*cut).difference(self.ids_of))
        made = [np.frombuffer(b"".join(map(self.ids_of.__getitem__, units)), "<u4") for units in cut]
        for unit in {u for units in cut for u in units if len(u) > bpe.CACHED_CHARS}:
            del self.ids_of[unit]
        return made


class PlainEncoder:
    """Byte-level BPE where special strings are plain text."""

    def __init__(self, path: str):
        self.inner = bpe.encoder(path)
        self.token_bytes, self.digits = self.inner.token_bytes, self.inner.digits
        self.sizes = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        # Where every byte is a token, merging bytes never loses one.
        self.lossless = len({b for b in self.token_bytes if len(b) == 1}) == 256

    def encode(self, text: str) -> np.ndarray:
        ids_of = self.inner.ids_of
        raw = b"".join(map(ids_of.__getitem__, self.inner.pretokens(text)))
        ids_of.trim()
        return np.frombuffer(raw, "<u4")


@lru_cache(maxsize=2)
def encoders(a: str, b: str) -> tuple[PlainEncoder, PieceEncoder]:
    return PlainEncoder(a), PieceEncoder(b)


@lru_cache(maxsize=2)
def written(a: PlainEncoder, b: PieceEncoder) -> list[str]:
    """What each token writes: an id of A inside its group, at the end of A's
    side, an id of B inside its group, at the end of the group."""
    return [d + mark for enc, marks in ((a, ",|"), (b, ",;")) for mark in marks for d in enc.digits]


# -- diagonal run skipping ----------------------------------------------------
def irregular(ends_a: list[int], ends_b: list[int]) -> list[int]:
    """a0, a1, b0, b1 of every group that is not one-to-one, one after another.
    Both arrays are strictly ascending and end with the same number."""
    out, i, j, n = [], 0, 0, len(ends_a)
    while i < n:
        step = PROBE
        while i < n and ends_a[i:i + step] == ends_b[j:j + step]:       # jump, each time twice as far
            size = min(step, n - i)
            i, j, step = i + size, j + size, step * 2
        while step > 1 and i < n:                                       # the rest of the stretch
            step //= 2
            if ends_a[i:i + step] == ends_b[j:j + step]:
                i, j = i + step, j + step
        if i < n:                                                       # the shift changes in here
            a0, b0, a, b = i, j, ends_a[i], ends_b[j]
            while a != b:
                if a < b:
                    i += 1
                    a = ends_a[i]
                else:
                    j += 1
                    b = ends_b[j]
            i, j = i + 1, j + 1
            out += a0, i, b0, j
    return out


def segments(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int, bool]]:
    """(a0, a1, b0, b1, one_to_one): consecutive stretches of both token
    sequences.  A one-to-one stretch holds a1 - a0 groups of one token on either
    side, any other stretch is one group."""
    found = irregular(ends_a, ends_b)
    out, a, b = [], 0, 0
    for a0, a1, b0, b1 in zip(*(iter(found),) * 4):
        if a0 > a:
            out.append((a, a0, b, b0, True))
        out.append((a0, a1, b0, b1, False))
        a, b = a1, b1
    if a < len(ends_a):
        out.append((a, len(ends_a), b, len(ends_b), True))
    return out


def last_in_group(n: int, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """True for the last token of every group: all ``n`` tokens but those before
    the last one of an irregular group, ``first`` to ``past`` - 1."""
    change = np.zeros(n, dtype=np.int32)
    change[first] += 1
    change[past - 1] -= 1
    return np.cumsum(change) == 0


def groups_text(ids_a, ids_b, last_a, last_b, a: PlainEncoder, b: PieceEncoder) -> str:
    """``a1,a2|b1;a3|b2,b3``: the tokens of each group side by side, each with the mark behind it."""
    at_a, at_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
    size_a, size_b = len(ids_a), len(ids_b)
    order = np.empty(size_a + size_b, dtype=np.int64)
    before_b = np.concatenate([[0], at_b + 1])                # tokens of B in the groups before
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    in_a, in_b = len(a.digits), len(b.digits)
    order[np.arange(size_a) + before_b[group_a]] = ids_a + last_a * in_a
    order[np.arange(size_b) + (at_a + 1)[group_b]] = ids_b + (2 * in_a + last_b * in_b)
    return "".join(map(written(a, b).__getitem__, order.tolist()))[:-1]


def _spells(token_bytes: list[bytes], ids: np.ndarray, raw: bytes) -> bool:
    return b"".join(map(token_bytes.__getitem__, ids.tolist())) == raw


def align_text(a: PlainEncoder, b: PieceEncoder, text: str, ids_b: np.ndarray, outputs) -> list:
    """The wanted output values of one text and its B ids."""
    raw = (" " + text).encode("utf-8")
    ids_a = a.encode(" " + text) if text else ()
    whole = bool(text) and _spells(b.token_bytes, ids_b, raw) and (a.lossless or _spells(a.token_bytes, ids_a, raw))
    if not whole:
        none = {"n_a": 0, "n_b": 0, "n_groups": 0, "groups": "", "groups_sha256": "", "links": b"", "link_times": b""}
        return [none[o] for o in outputs]
    ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
    found = irregular(np.cumsum(a.sizes[ids_a]).tolist(), np.cumsum(b.sizes[ids_b]).tolist())
    found = np.array(found, dtype=np.int64).reshape(-1, 4)
    last_a = last_in_group(len(ids_a), found[:, 0], found[:, 1])
    last_b = last_in_group(len(ids_b), found[:, 2], found[:, 3])
    links, times = np.unique(ids_b[last_b] << 32 | ids_a[last_a], return_counts=True)
    text = groups_text(ids_a, ids_b, last_a, last_b, a, b) if {"groups", "groups_sha256"} & set(outputs) else ""
    made = {"n_a": lambda: len(ids_a), "n_b": lambda: len(ids_b), "n_groups": lambda: int(last_a.sum()),
            "groups": lambda: text, "groups_sha256": lambda: hashlib.sha256(text.encode()).hexdigest(),
            "links": lambda: links.astype("<i8").tobytes(), "link_times": lambda: times.astype("<u4").tobytes()}
    return [made[o]() for o in outputs]


def align(docs: DataFrame, text_col: str = "text", a: str | None = None, b: str | None = None,
          outputs=tuple(OUTPUTS), keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the wanted ``OUTPUTS``: numbers of tokens and groups, the
    groups as text and its digest, the distinct links (``B id << 32 | A id`` as
    little-endian int64, ascending) and how often each occurs (uint32)."""
    paths = a or bpe.default_path(), b or bpe.default_path("piece_bpe_32k.model")

    def run(texts):
        enc_a, enc_b = encoders(*paths)
        columns = [[] for _ in outputs]
        for start in range(0, len(texts), 64):
            part = [t or "" for t in texts[start:start + 64]]
            for text, ids_b in zip(part, enc_b.encode(part)):
                for column, value in zip(columns, align_text(enc_a, enc_b, text, ids_b, outputs)):
                    column.append(value)
        return columns

    return map_text(docs, run, ", ".join(f"{o} {OUTPUTS[o]}" for o in outputs), text_col, keep)


# -- corpus-wide counts -------------------------------------------------------
def _summed(links: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(links, kind="stable")
    links, times = links[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
    return links[first], np.add.reduceat(times, first)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, n, best): how often each pair of ids is linked in all rows of
    ``align``, and whether no other A id is linked more often to its B id."""
    def summarise(batches):
        held, size = [], 0

        def sent(links, times):
            return pa.RecordBatch.from_arrays([pa.array(links), pa.array(times)], names=["link", "n"])

        def joined():
            return _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

        for batch in parts_of(batches):
            for links, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if links:
                    held.append((np.frombuffer(links, "<i8"), np.frombuffer(times, "<u4").astype(np.int64)))
                    size += len(held[-1][0])
            if size > 2 * TASK_LINKS:
                links, times = joined()
                held, size = [(links, times)], len(links)
                if size > TASK_LINKS:
                    yield sent(links, times)
                    held, size = [], 0
        if held:
            yield sent(*joined())

    parts = arrow_map(aligned.select("links", "link_times"), summarise, "link long, n long")
    counts = staged(parts.groupBy("link").agg(F.sum("n").alias("n")), "link-counts")
    b_id = F.shiftright("link", 32)
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))      # one row per id of B at most
    return counts.join(F.broadcast(highest), b_id == F.col("b")).select(
        "link", "n", (F.col("n") == F.col("top")).alias("best"))


def frequent(counts: DataFrame, most: int = TABLE_LINKS):
    """(links, n, best) as arrays in ascending order of the links: all pairs
    that occur at least 2^k times, for the smallest k that leaves at most
    ``most`` of them."""
    bucket = F.floor(F.log2("n")).cast("int").alias("bucket")
    sizes = {r.bucket: r.c for r in counts.groupBy(bucket).agg(F.count("*").alias("c")).collect()}   # 63 at most
    least, total = None, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        least = k
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    rows = counts.where(F.floor(F.log2("n")) >= least).toArrow()                 # at most ``most`` rows
    links, n, best = (rows.column(c).to_numpy() for c in ("link", "n", "best"))
    order = np.argsort(links)
    return links[order], n[order], best[order]


def score_links(aligned: DataFrame, counts: DataFrame, most: int = TABLE_LINKS) -> DataFrame:
    """``aligned`` (with ``ROW``, a number of its own in each row) with
    n_links, n_best (links whose count is the highest of their B id) and
    count_sum (sum of all links' counts)."""
    spark = aligned.sparkSession
    shared = spark.sparkContext.broadcast(frequent(counts, most))
    keep = [c for c in aligned.columns if c not in ("links", "link_times", "n_links", "n_best", "count_sum")]
    names = [*keep, "n_links", "n_best", "count_sum", "missed", "missed_times"]

    def run(batches):
        known, n, best = shared.value
        for batch in parts_of(batches):
            sums, missed, missed_times = [], [], []
            at = batch.schema.get_field_index("links")
            for links, times in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()):
                links, times = np.frombuffer(links or b"", "<i8"), np.frombuffer(times or b"", "<u4").astype(np.int64)
                place = np.minimum(np.searchsorted(known, links), max(0, len(known) - 1))
                hit = known[place] == links if len(known) else np.zeros(len(links), bool)
                place = place[hit]
                sums.append((int(times.sum()), int(times[hit][best[place]].sum()) if len(place) else 0,
                             int((times[hit] * n[place]).sum()) if len(place) else 0))
                missed.append(links[~hit])
                missed_times.append(times[~hit])
            made = [pa.array([s[k] for s in sums], pa.int64()) for k in range(3)]
            made += [pa.array(m, pa.list_(pa.int64())) for m in (missed, missed_times)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, names=names)

    source = aligned.select(*keep, "links", "link_times")
    schema = T.StructType([*[source.schema[c] for c in keep], *T.StructType.fromDDL(
        "n_links long, n_best long, count_sum long, missed array<long>, missed_times array<long>")])
    scored = staged(arrow_map(source, run, schema), "scored")
    rare = scored.select(ROW, F.explode(F.arrays_zip("missed", "missed_times")).alias("m")).select(
        ROW, F.col("m.missed").alias("link"), F.col("m.missed_times").alias("times"))
    rest = rare.join(counts, "link").groupBy(ROW).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rest_best"),
        F.sum(F.col("times") * F.col("n")).alias("rest_sum"))
    return scored.drop("missed", "missed_times").join(rest, ROW, "left").select(
        *keep, "n_links", (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"))


def align_corpus(docs: DataFrame, text_col: str = "text", a: str | None = None, b: str | None = None,
                 outputs=QUERY_OUTPUTS, keep: list[str] | None = None) -> DataFrame:
    """``align`` over all rows, with n_links, n_best and count_sum."""
    spark = docs.sparkSession
    wanted = [*[o for o in outputs if o not in ("links", "link_times")], "links", "link_times"]
    rows = align(docs, text_col, a, b, wanted, keep).withColumn(ROW, F.monotonically_increasing_id())
    path = shared_dir(spark, "aligned")
    rows.write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(rows.schema).parquet(path)
    return score_links(aligned, staged(link_counts(aligned), "link-table")).drop(ROW)


def query(spark, sf_dir: str) -> DataFrame:
    return align_corpus(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
