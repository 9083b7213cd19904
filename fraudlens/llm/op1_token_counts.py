"""Token counts by a map-side two-tier lookup.

Tier 1 is a compact table of the lengths (in tokens) of the corpus's most
frequent pre-tokens, broadcast to all workers; tier 2 encodes what is not in
it through a bounded cache of the worker process.  No pre-token is ever
shuffled and documents stay in their input partitions.  The table only saves
time: counts are exact whatever it holds.

How the table is made: every task reads all its texts and keeps at most
``2 * TASK_ENTRIES`` pre-token counters (lossy counting: on overflow the rare
half goes), sends its ``TASK_ENTRIES`` best to one partial-aggregated sum,
and the ``TABLE_ENTRIES`` best sums become the table.  So the shuffle holds a
fixed number of rows per input split, and the table at most ``TABLE_ENTRIES``
entries of at most ``bpe.CACHED_CHARS`` characters (about 5 MB), whatever the
size of the corpus.

Defined cases: null and empty texts have 0 tokens and 0 bytes; texts of any
length are counted whole; repeated rows give repeated results; an empty table
gives an empty result; an input column named like an output is replaced.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm import bpe
from fraudlens.llm.common import arrow_map, map_text, parts_of, table

TABLE_ENTRIES = 65_536
TASK_ENTRIES = 4_096
LIMIT = 512
OUTPUTS = "n_bytes long, n_tokens long, over_limit boolean"


def frequent_pretokens(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None,
                       entries: int = TABLE_ENTRIES) -> DataFrame:
    """(pretoken, n): the most frequent pre-tokens of all texts, at most
    ``entries`` rows; ties go to the smaller pre-token."""
    path = tokenizer or bpe.default_path()

    def summarise(batches):
        enc, seen = bpe.encoder(path), Counter()
        for batch in parts_of(batches):
            for text in batch.column(0).to_pylist():
                for stretch, added in enc.segments(text or ""):
                    if added is None:
                        seen.update(enc.pretokens(stretch))
                if len(seen) > 64 * TASK_ENTRIES:
                    seen = Counter(dict(seen.most_common(32 * TASK_ENTRIES)))
        best = [(t, n) for t, n in seen.most_common(TASK_ENTRIES) if len(t) <= bpe.CACHED_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in best], pa.string()),
                                          pa.array([n for _, n in best], pa.int64())],
                                         names=["pretoken", "n"])

    parts = arrow_map(docs.select(docs[text_col]), summarise, "pretoken string, n long")
    return (parts.groupBy("pretoken").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "pretoken").limit(entries))


def length_table(docs: DataFrame, text_col: str = "text",
                 tokenizer: str | None = None) -> tuple[bytes, bytes]:
    """The broadcast form: pre-tokens joined by NUL and their lengths, one
    byte each (a cached pre-token has at most 4 * CACHED_CHARS tokens; the
    few that contain NUL or need more than one byte are left out)."""
    enc = bpe.encoder(tokenizer or bpe.default_path())
    names, lengths = [], bytearray()
    for row in frequent_pretokens(docs, text_col, tokenizer).collect():   # <= TABLE_ENTRIES rows
        n = len(enc.encode_pretoken(row.pretoken)) // 4
        if n < 256 and "\0" not in row.pretoken:
            names.append(row.pretoken)
            lengths.append(n)
    return "\0".join(names).encode(), bytes(lengths)


class _Lengths:
    """Worker-side lookup for one broadcast table."""

    current: tuple | None = None

    @classmethod
    def of(cls, key, path: str, payload: tuple[bytes, bytes]) -> tuple[bpe.Encoder, bpe.Cache]:
        if cls.current is None or cls.current[0] != key:
            enc = bpe.encoder(path)
            names, lengths = payload
            fixed = dict(zip(names.decode().split("\0"), lengths)) if lengths else {}
            cls.current = (key, enc, bpe.Cache(lambda t: len(enc.encode_pretoken(t)) // 4, fixed=fixed))
        return cls.current[1:]


def count_tokens(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None,
                 limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    path = tokenizer or bpe.default_path()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(length_table(docs, text_col, path))
    key = uuid.uuid4().hex       # a reused worker may hold another call's table

    def count(texts):
        enc, lengths = _Lengths.of(key, path, shared.value)
        n_bytes, n_tokens = [], []
        for text in texts:
            text = text or ""
            n = 0
            for stretch, added in enc.segments(text):
                n += 1 if added is not None else sum(map(lengths.__getitem__, enc.pretokens(stretch)))
            lengths.trim()
            n_bytes.append(len(text) if text.isascii() else len(text.encode("utf-8")))
            n_tokens.append(n)
        return n_bytes, n_tokens, [n > limit for n in n_tokens]

    return map_text(docs, count, OUTPUTS, text_col, keep)


def query(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), keep=["doc_id"])
