"""Benchmark decontamination by a broadcast set of normalised n-grams.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of
fewer words is one window).  The distinct windows are made by Spark, put into
blocks of at most ``BLOCK_WINDOWS`` and broadcast as a hash set; each task
slides over the words of its documents, looks the window hashes up, verifies
every hit word by word, and marks the covered words.  Documents are never
shuffled.  With more than one block the marks are carried from block to block
in columns (written to the shared folder in between, so that only one block
is in memory); a benchmark of any size is compared whole.

Results: counts and item ids, the document-level verdict, the hit spans, and
the text with the hit spans cut out.

Defined cases: null text has no words and is clean; empty and white-space
texts too; texts of any length are scanned whole; null items are ignored,
repeated items count by their distinct ids; an item id of null counts as
"null"; an empty benchmark leaves everything clean; an input column named
like an output is replaced.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.bpe import Cache
from fraudlens.llm.common import TEXT, arrow_map, arrow_type, map_text, staged, table

WINDOW = 10
BLOCK_WINDOWS = 1_000_000
OUTPUTS = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string",
           "contaminated": "boolean", "items": "array<string>",
           "hit_spans": "array<array<int>>", "clean_text": "string"}
QUERY_OUTPUTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
# Lower-cases A-Z; every other ASCII character but digits becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8").translate(_FOLD)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(gram, item): the distinct windows (words joined by a space) and the
    item they come from."""
    def cut(batches):
        for batch in batches:
            grams, items = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = folded(text).split()
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    grams.append(b" ".join(words[i:i + window]).decode())
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()),
                                              pa.array(items, pa.string())], names=["gram", "item"])

    source = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("null")),
                              benchmark[text_col])
    return arrow_map(source, cut, "gram string, item string").distinct()


class Windows:
    """Look-up structure of one block, built once in each worker."""

    built: tuple | None = None

    @classmethod
    def of(cls, key: str, grams: list[tuple[str, str]]) -> "Windows":
        if cls.built is None or cls.built[0] != key:
            cls.built = (key, cls(grams))
        return cls.built[1]

    def __init__(self, grams: list[tuple[str, str]]):
        items_of = defaultdict(list)
        for gram, item in grams:
            items_of[tuple(gram.encode().split(b" "))].append(item)
        self.vocab = {}
        for gram in items_of:
            for word in gram:
                self.vocab.setdefault(word, len(self.vocab) + 1)    # 0: not in any window
        by_length = defaultdict(list)
        for gram in items_of:
            by_length[len(gram)].append(gram)
        self.tables = []
        for n, own in sorted(by_length.items()):
            ids = np.array([[self.vocab[w] for w in g] for g in own], dtype=np.uint64)
            seed = 1
            while True:                       # until no two windows share a hash
                powers = np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
                hashes = (ids * powers).sum(axis=1, dtype=np.uint64)
                order = np.argsort(hashes)
                if len(own) < 2 or (np.diff(hashes[order]) != 0).all():
                    break
                seed += 1
            self.tables.append((n, powers, hashes[order], ids[order], [items_of[own[i]] for i in order]))

    def scan(self, docs: list[list[bytes]]):
        """For each document a list of hit (start, end) word spans, one per
        occurring window, and the set of items of those windows."""
        Cache.release()
        get = self.vocab.get
        sizes = np.array([len(d) + 1 for d in docs])
        ids = np.zeros(int(sizes.sum()), dtype=np.uint64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        for at, words in zip(starts, docs):   # a 0 after each document keeps windows inside it
            ids[at:at + len(words)] = [get(w, 0) for w in words]
        spans, items = defaultdict(list), defaultdict(set)
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for n, powers, hashes, grams, gram_items in self.tables:
            if len(ids) < n:
                continue
            at = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(at):
                continue
            found = ids[at[:, None] + np.arange(n)]
            value = (found * powers).sum(axis=1, dtype=np.uint64)
            slot = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            same = np.flatnonzero((hashes[slot] == value) & (grams[slot] == found).all(axis=1))
            owner = np.searchsorted(starts, at[same], side="right") - 1
            for d, start, s in zip(owner.tolist(), (at[same] - starts[owner]).tolist(), slot[same].tolist()):
                spans[d].append((start, start + n))
                items[d].update(gram_items[s])
        return spans, items


def merged(spans) -> list[list[int]]:
    """Overlapping or touching (start, end) spans as disjoint ones."""
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def cut_spans(text: str, spans) -> str:
    """``text`` without the characters from the first to the last word of
    each span."""
    raw, words = text.encode("utf-8"), list(_WORD.finditer(folded(text)))
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:words[a].start()])
        at = words[b - 1].end()
    return b"".join(kept + [raw[at:]]).decode("utf-8")


def _values(outputs, text, n_words, spans, items) -> list:
    names = sorted(items)
    made = {
        "n_words": lambda: n_words,
        "n_hit": lambda: sum(b - a for a, b in spans),
        "n_items": lambda: len(names),
        "items_sha256": lambda: hashlib.sha256(",".join(names).encode()).hexdigest(),
        "contaminated": lambda: bool(spans),
        "items": lambda: names,
        "hit_spans": lambda: spans,
        "clean_text": lambda: cut_spans(text, spans) if spans else text,
    }
    return [made[o]() for o in outputs]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  outputs: tuple = ("n_hit", "contaminated", "items", "hit_spans", "clean_text"),
                  keep: list[str] | None = None, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with the wanted ``outputs`` (names of ``OUTPUTS``)."""
    ddl = ", ".join(f"`{o}` {OUTPUTS[o]}" for o in outputs)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    sc = docs.sparkSession.sparkContext
    grams = item_windows(benchmark, item_id, item_text, window)
    blocks = 1
    if (n := grams.count()) > block_windows:
        grams, blocks = staged(grams, "windows"), -(-n // block_windows)

    def block(k: int):
        own = grams if blocks == 1 else grams.where(
            F.pmod(F.xxhash64("gram", "item"), F.lit(blocks)) == k)
        return uuid.uuid4().hex, sc.broadcast([(r.gram, r.item) for r in own.collect()])

    def words_of(texts):
        return [folded(t).split() for t in texts]

    if blocks == 1:
        key, shared = block(0)

        def whole(texts):
            words = words_of(texts)
            spans, items = Windows.of(key, shared.value).scan(words)
            rows = [_values(outputs, t, len(w), merged(spans.get(i, ())), items.get(i, ()))
                    for i, (t, w) in enumerate(zip(texts, words))]
            return list(zip(*rows))

        return map_text(docs, whole, ddl, text_col, keep)

    state = docs.select(F.struct(*[docs[c] for c in keep] or [F.lit(0).alias("none")]).alias("kept"),
                        docs[text_col].alias(TEXT),
                        F.array().cast("array<array<int>>").alias("spans"),
                        F.array().cast("array<string>").alias("items"))
    schema = state.schema
    for k in range(blocks):
        key, shared = block(k)

        def one(batches, key=key, shared=shared):
            for batch in batches:
                spans, items = Windows.of(key, shared.value).scan(words_of(batch.column(1).to_pylist()))
                old_spans, old_items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1),
                    pa.array([merged([*s, *spans.get(i, ())]) for i, s in enumerate(old_spans)],
                             pa.list_(pa.list_(pa.int32()))),
                    pa.array([sorted({*s, *items.get(i, ())}) for i, s in enumerate(old_items)],
                             pa.list_(pa.string()))], names=schema.names)

        state = staged(arrow_map(state, one, schema), "decontaminate")

    made = T.StructType.fromDDL(ddl)
    types = [arrow_type(f.dataType) for f in made]

    def last(batches):
        for batch in batches:
            rows = [_values(outputs, t, len(folded(t).split()), s, i) for t, s, i in
                    zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([r[c] for r in rows], type=t) for c, t in enumerate(types)],
                names=["kept", *outputs])

    out = arrow_map(state, last, T.StructType([schema["kept"], *made]))
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], *outputs)


def query(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                         outputs=QUERY_OUTPUTS, keep=["doc_id"])


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.n, p.i, g.item FROM places p JOIN grams g ON p.n = g.n AND p.gram = g.gram),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
