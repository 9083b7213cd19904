"""Embedding near-duplicates by Euclidean p-stable hashing.

Each of several tables hashes a normalised vector to a bucket by k quantised
random projections, floor((a . x + b) / w) with Gaussian a and uniform b.
Vectors that share a bucket and whose ``SKETCH_BITS`` sign bits differ in at
most ``SKETCH_LIMIT`` places become candidates; the components of the
candidate relation are families, and inside a family every pair is checked by
exact cosine in double precision, block against block, by matrix products.
So a link needs to be found by one chain of buckets only, and no pair rows
are ever made: tasks emit counts per vector and one row per vector for its
component.

k and the number of tables follow from the number of vectors: a bucket holds
about ``FAR`` unrelated vectors, and a pair exactly at the limit shares a
bucket of some table with probability ``RECALL`` (closer pairs more often).

Skew: equal vectors are one vector from the start; a bucket with many rows in
one task first hands over its rows that differ in at most ``NEAR_BITS`` sign
bits from a leader (they stay linked to it, and the limit for other tasks'
rows leaves room for that); a family of any size is compared in blocks of
``BLOCK`` vectors over many tasks.

Defined cases: null, empty and zero vectors, vectors with null or non-finite
components and rows with a null id link with nothing (a null id gets a null
component); vectors of different length never link; repeated rows are
separate vectors with the same id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import arrow_map, staged, table
from fraudlens.llm.components import components

COSINE = 0.9
WIDTH = 2.0
FAR, RECALL = 8, 0.97
SKETCH_BITS, SKETCH_LIMIT = 192, 60
HOT_ROWS, NEAR_BITS = 256, 12
BLOCK = 1_024
FLUSH = 4_096                # vectors hashed together
SEED = 20_011


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees at this distance."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """(projections per table, tables) for n vectors."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n / FAR, 1.0)) / -math.log(far)))
    return k, math.ceil(math.log(1 - RECALL) / math.log(1 - near ** k))


class Hasher:
    """Projections for one vector length; the same on every worker."""

    _made: dict = {}

    @classmethod
    def of(cls, dims: int, k: int, tables: int) -> "Hasher":
        key = (dims, k, tables)
        if key not in cls._made:
            if len(cls._made) > 8:
                cls._made.clear()
            cls._made[key] = cls(*key)
        return cls._made[key]

    def __init__(self, dims: int, k: int, tables: int):
        rng = np.random.default_rng([SEED, dims, k, tables])
        self.k, self.tables = k, tables
        self.a = rng.standard_normal((dims, k * tables))
        self.b = rng.uniform(0, WIDTH, k * tables)
        self.odd = rng.integers(1, 1 << 63, k * tables, dtype=np.uint64) | np.uint64(1)
        self.start = rng.integers(0, 1 << 63, tables, dtype=np.uint64) + np.uint64(dims)
        self.sketch = np.random.default_rng([SEED, dims]).standard_normal((dims, SKETCH_BITS))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables) bucket keys; the table is part of the key."""
        cell = np.floor((x @ self.a + self.b) / WIDTH).astype(np.int64).view(np.uint64)
        h = (cell * self.odd).reshape(len(x), self.tables, self.k).sum(axis=2, dtype=np.uint64) + self.start
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))

    def sketches(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.sketch > 0, axis=1).view(np.uint64)


def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of different sketch bits, over the last axis."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)        # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_length(vectors: list):
    """(indices, unit vectors) for each vector length of a batch."""
    sizes = np.array([len(v) for v in vectors])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield at, unit([vectors[i] for i in at])


def leaders(sketches: np.ndarray, limit: int) -> np.ndarray:
    """For each row the row that leads it: leaders are taken in order, and
    lead all rows within ``limit`` bits that have no leader yet."""
    lead, left = np.full(len(sketches), -1), np.arange(len(sketches))
    while len(left):
        near = differ(sketches[left], sketches[left[0]]) <= limit
        lead[left[near]] = left[0]
        left = left[~near]
    return lead


def bucket_links(sketches: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever ``SKETCH_LIMIT`` connects in a bucket: all
    rows to their leaders, and leaders whose groups touch."""
    lead = leaders(sketches, SKETCH_LIMIT)
    links = [(i, k) for i, k in enumerate(lead) if i != k]
    heads = np.unique(lead)
    name = {h: h for h in heads}

    def root(h):
        while name[h] != h:
            h = name[h]
        return h

    groups = {h: np.flatnonzero(lead == h) for h in heads}
    for i, h in enumerate(heads):
        own = sketches[groups[h]]
        for other in heads[i + 1:]:
            if len(own) == len(groups[other]) == 1 or root(h) == root(other):
                continue                             # two lone leaders are known to be apart
            theirs = sketches[groups[other]]
            if any((differ(own[s:s + 512, None], theirs[None]) <= SKETCH_LIMIT).any()
                   for s in range(0, len(own), 512)):
                links.append((h, other))
                name[root(other)] = root(h)
    return links


_ROW = "key long, node long, s0 long, s1 long, s2 long"


def _rows(keys, nodes, sketches) -> pa.RecordBatch:
    s = sketches.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(nodes)] + [pa.array(s[:, i].copy()) for i in range(3)],
        names=["key", "node", "s0", "s1", "s2"])


def bucket_rows(reps: DataFrame, k: int, tables: int) -> DataFrame:
    """A row per vector and table; hot buckets of a task are thinned to their
    leaders, whose links travel as two rows of a key of their own."""
    def run(batches):
        for batch in batches:
            for from_row in range(0, batch.num_rows, FLUSH):
                part = batch.slice(from_row, FLUSH)
                nodes = part.column(0).to_numpy()
                for at, x in by_length(part.column(1).to_pylist()):
                    hasher = Hasher.of(x.shape[1], k, tables)
                    sketch = hasher.sketches(x)
                    keys = hasher.keys(x).ravel()
                    owner = np.repeat(np.arange(len(at)), tables)
                    order = np.argsort(keys, kind="stable")
                    keys, owner = keys[order], owner[order]
                    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                    sizes = np.diff(np.append(first, len(keys)))
                    keep, pairs = np.ones(len(keys), dtype=bool), set()
                    for s, n in zip(first[sizes >= HOT_ROWS], sizes[sizes >= HOT_ROWS]):
                        own = owner[s:s + n]
                        lead = leaders(sketch[own], NEAR_BITS)
                        keep[s:s + n] = lead == np.arange(n)
                        pairs.update(zip(own[lead[lead != np.arange(n)]].tolist(),
                                         own[lead != np.arange(n)].tolist()))
                    yield _rows(keys[keep], nodes[at[owner[keep]]], sketch[owner[keep]])
                    if pairs:
                        p = np.array(sorted(pairs))
                        own_key = (nodes[at[p[:, 0]]].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                                   + nodes[at[p[:, 1]]].view(np.uint64)) ^ np.uint64(SEED)
                        for side in (0, 1):          # the leader's sketch on both: they count as near
                            yield _rows(own_key, nodes[at[p[:, side]]], sketch[p[:, 0]])

    return arrow_map(reps.select("node", "embedding"), run, _ROW)


def candidate_links(rows: DataFrame) -> DataFrame:
    """(a, b) stars over the vectors that meet in a bucket and look alike."""
    def links_of(keys, nodes, sketches):
        out = []
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(first, len(keys)))
        small = np.repeat(sizes <= 64, sizes)
        for d in range(1, int(sizes[sizes <= 64].max(initial=1))):
            i = np.flatnonzero(small[:-d] & (keys[d:] == keys[:-d]))
            i = i[differ(sketches[i], sketches[i + d]) <= SKETCH_LIMIT]
            out.append(np.stack([nodes[i], nodes[i + d]], axis=1))
        for s, n in zip(first[sizes > 64], sizes[sizes > 64]):
            found = bucket_links(sketches[s:s + n])
            if found:
                out.append(nodes[s:s + n][np.array(found)])
        pairs = np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
        return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)

    def run(batches):
        held = None                                  # the last bucket may go on in the next batch
        for batch in batches:
            part = [batch.column(i).to_numpy() for i in range(5)]
            part = [part[0], part[1], np.stack(part[2:], axis=1).view(np.uint64)]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            cut = int(np.searchsorted(part[0], part[0][-1])) if len(part[0]) else 0
            held = [x[cut:] for x in part]
            if cut:
                pairs = links_of(*[x[:cut] for x in part])
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        if held is not None and len(held[0]):
            pairs = links_of(*held)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return arrow_map(dealt, run, "a long, b long")


def block_labels(adjacent: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Smallest id that each row and column reaches inside one block pair."""
    big = np.iinfo(np.int64).max
    while True:
        to_left = np.minimum(left, np.where(adjacent, right[None, :], big).min(axis=1, initial=big))
        to_right = np.minimum(right, np.where(adjacent, to_left[:, None], big).min(axis=0, initial=big))
        if (to_left == left).all() and (to_right == right).all():
            return left, right
        left, right = to_left, to_right


def exact_links(members: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root): for each block pair that a vector takes part in,
    the weight of the vectors linked to it and the smallest id it reaches.
    ``members``: node, copies, embedding, family."""
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("int").alias("blocks"))
    placed = members.join(sizes, "family").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "node", "copies", "embedding")
             .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "block"))

    def compare(batches):
        group, rows = None, []

        def done():
            block, node, copies = (np.array([r[c] for r in rows], dtype=np.int64) for c in range(3))
            same = group[1] == group[2]
            nodes, links, roots = [], [], []
            sizes = np.array([len(r[3]) for r in rows])
            for n in np.unique(sizes):               # vectors of one length
                at = np.flatnonzero(sizes == n)
                x = unit([rows[i][3] for i in at])
                a = at if same else at[block[at] == group[1]]
                b = at if same else at[block[at] != group[1]]
                if not len(a) or not len(b):
                    continue
                pos = np.full(len(rows), -1)
                pos[at] = np.arange(len(at))
                near = x[pos[a]] @ x[pos[b]].T >= cosine
                if same:
                    np.fill_diagonal(near, False)
                left, right = block_labels(near, node[a], node[b])
                nodes.append(node[a])
                links.append(near @ copies[b])
                roots.append(np.minimum(left, right) if same else left)
                if not same:
                    nodes.append(node[b])
                    links.append(copies[a] @ near)
                    roots.append(right)
            empty = np.zeros(0, dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([empty, *c]).astype(np.int64)) for c in (nodes, links, roots)],
                names=["node", "links", "root"])

        for batch in batches:
            for f, i, j, *row in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if (f, i, j) != group:
                    if len(rows) > 1:
                        yield done()
                    group, rows = (f, i, j), []
                rows.append(row)
        if len(rows) > 1:
            yield done()

    return arrow_map(dealt, compare, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """One row per input row: id_col, n_links, component_id, kept."""
    v = F.col("embedding")
    good = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(v, lambda x: x != 0) & F.col("vec").isNotNull())
    rows = vectors.select(vectors[id_col].cast("long").alias("vec"), vectors[vector_col].alias("embedding"))
    rows = rows.select("vec", "embedding", F.coalesce(good, F.lit(False)).alias("good"),
                       F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(SEED), "embedding").alias("h2"))
    # Equal vectors are one node, named after the smallest id among them.  An
    # id with several vectors keeps a node for each, numbered by their hash.
    reps = staged(rows.where("good").groupBy("h1", "h2").agg(
        F.min("vec").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("node", F.xxhash64("h1", "h2")), "vectors")
    k, tables = plan(reps.count(), cosine)
    families = staged(components(candidate_links(bucket_rows(reps, k, tables)))
                      .withColumnRenamed("component", "family"), "families")
    found = staged(exact_links(reps.select("node", "copies", "embedding").join(families, "node"), cosine),
                   "exact-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # Nodes that share an id (one id, several vectors) need no link of their own.
    ids = reps.select("h1", "h2", "node", "rep", "copies").join(counts, "node", "left").join(roots, "node", "left")
    least = (ids.groupBy(F.coalesce("component", "node").alias("class")).agg(F.min("rep").alias("component_id")))
    named = staged(ids.withColumn("class", F.coalesce("component", "node")).join(least, "class").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "linked")
    out = rows.select("vec", "good", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec"))
    return out.select(F.col("vec").alias(id_col),
                      F.when(F.col("good"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec") == component).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT r.x AS vec_id, CAST(coalesce(any_value(n_links), 0) AS BIGINT) AS n_links,
       min(r.y) AS component_id, r.x = min(r.y) AS kept
FROM reach r LEFT JOIN n ON n.x = r.x GROUP BY r.x
"""
