"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct shingles of ``words`` words (4 in the
query; as 64-bit hashes).
Shingles are hashed into groups; a set becomes the point of its group counts.
The overlap of two sets is at most the sum of the coordinate-wise minima of
their points, so an R-tree over the points, searched with that bound, leaves
few pairs, and those are verified on the sets themselves.

Distribution: a tree over the whole corpus would be one task's, so its root
level is a lossless split by the same groups.  Linked sets of a size band
differ in at most D shingles, so of ``D + 1 + spare`` groups at least one that
is not empty holds exactly the same shingles in both (rows with more than
``spare`` empty groups, and sets too small for groups, use the D + 1 smallest
shingles instead, which cannot all be missed either).  Every set sends one row
per group (band, group, content).  Sets that meet in a row and that the bound
on their points does not keep apart (a shared passage fills whole groups, but
not the point) make a family; families are the components of that relation,
and each has its own R-tree.  A family of more than ``BLOCK_SETS`` sets is
compared block by block.

Skew: equal sets are one set from the start (one representative, smallest
id); near copies in one task send only what their leader has not sent (see
``thinned``); and inside a family only links that join two components so far
apart are verified and kept, so a group of n near copies costs about n
verifications and n rows, not n * n.

Defined cases: null and empty texts (and a null id) have no links; a null id
gets a null component; repeated rows have the same component; a text with
fewer words than a shingle is one shingle; texts of any length are used whole; an
empty table gives an empty result.  Hash equality stands for shingle
equality (64 bits: below 1e-7 wrong matches per pair of 10,000-word texts).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.bpe import Cache
from fraudlens.llm.common import arrow_map, maybe_in, parts_of, staged, table
from fraudlens.llm.components import components

N = 4
PERCENT = 85
BAND = 1.5                   # ratio of a size band's ends
SMALL = 32                   # smaller sets use their smallest shingles only
BLOCK_SETS, BLOCK_BYTES = 2_000, 32 << 20
SEEN_SETS = 200_000          # of which a task remembers that they were sent
FLUSH_ROWS = 1_500_000       # shingles of a task looked at together before the shuffle
HOT_ROWS, NEAR = 16, 0.02    # thinning of a task's near copies
SHORT_RUN = 64
COARSE = 64                  # fewest groups of the points that families are told apart by
LEAF = 32                    # points in a leaf, children of an inner node
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


# -- sets ---------------------------------------------------------------------
def _word_hash(word: bytes) -> bytes:
    import xxhash
    return xxhash.xxh3_64_digest(word)


_words = Cache(_word_hash, entries=200_000)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K[1]
    h = (h ^ (h >> np.uint64(27))) * _K[2]
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or "").encode("utf-8").lower().split()     # bytes: A-Z, ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.frombuffer(b"".join(map(_words.__getitem__, words)), dtype=">u8").astype(np.uint64)
    _words.trim()
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out *= _K[0]
        out += h[k:len(h) - n + 1 + k]
    return np.unique(mix(out))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the whole set; (0, 0) if empty."""
    a = int(mix(s ^ _K[0]).sum(dtype=np.uint64))
    b = int(mix(s * _K[1] + _K[2]).sum(dtype=np.uint64))
    return tuple(x - (1 << 64) if x >> 63 else x for x in (a, b))


def sets_of(docs: DataFrame, id_col: str, text_col: str, words: int = N) -> DataFrame:
    """(doc, n, f1, f2, point): size, fingerprint and point of every row's set."""
    def run(batches):
        for batch in parts_of(batches):
            sets = [shingles(t, words) for t in batch.column(1).to_pylist()]
            prints = [fingerprint(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                 pa.array([point_bytes(s) for s in sets], pa.binary())], names=["doc", "n", "f1", "f2", "point"])

    source = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col])
    return arrow_map(source, run, "doc long, n long, f1 long, f2 long, point binary")


# -- families -----------------------------------------------------------------
def differing(n_small: float, percent: int) -> int:
    """The most shingles in which a set of at most ``n_small`` and a larger
    set can differ and still be linked."""
    share = (100 - percent) / (100 + percent)
    return int(share * (n_small + n_small * 100 / percent) + 1e-9)


def bands(n: int, percent: int) -> list[int]:
    """The size bands in which a set of n shingles may meet a partner that is
    not larger: its own, and lower ones that reach percent/100 of n."""
    band = int(np.floor(np.log(n) / np.log(BAND)))
    out = [band]
    while BAND ** band > n * percent / 100:          # lower end above the smallest partner
        band -= 1
        out.append(band)
    return out


def group_rows(s: np.ndarray, percent: int) -> np.ndarray:
    """The keys of one set: two linked sets share at least one."""
    n, keys = len(s), []
    by_hash = n * percent / 100 < SMALL              # a partner may be small
    if n >= SMALL:
        mixed = mix(s * _K[2])
        for band in bands(n, percent):
            need = differing(BAND ** (band + 1), percent) + 1
            spare = 1 + need // 24
            groups = need + spare
            place = ((s >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)   # ascending
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            content = np.add.reduceat(mixed, first)
            keys.append(mix(content + mix(place[first] * _K[0] + np.uint64(band + 1))))
            by_hash = by_hash or groups - len(first) > spare
    if by_hash:
        most = n - (n * percent + 99) // 100 + 1
        keys.append(mix(s[:most] + _K[0]))
    return np.concatenate(keys)


def thinned(found: list[tuple[int, np.ndarray, np.ndarray]]):
    """(keys, nodes) of the sets of one task.  A set that differs from a
    leader in at most ``NEAR`` of its shingles, in a key of ``HOT_ROWS`` sets or
    more, sends only the keys that its leader has not, and one pair of rows
    that links the two; the bound for families leaves room for that."""
    keys = np.concatenate([k for _, _, k in found])
    owner = np.repeat(np.arange(len(found)), [len(k) for _, _, k in found])
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    hot = np.unique(owner[count[name] >= HOT_ROWS])
    leaders: list[int] = []
    out_keys, out_nodes = [], []
    lead_of = {}
    for i in hot:
        s = found[i][1]
        lead = next((k for k in leaders if near(s, found[k][1])), None)
        if lead is not None:
            lead_of[i] = lead
        elif len(leaders) < 64:
            leaders.append(i)
    for i, (node, _, own) in enumerate(found):
        lead = lead_of.get(i)
        if lead is not None:
            own = np.setdiff1d(own, found[lead][2])
            pair = mix(np.array([found[lead][0] ^ node], dtype=np.int64).view(np.uint64) + _K[0])
            out_keys += [pair, pair]
            out_nodes += [np.array([found[lead][0]]), np.array([node])]
        out_keys.append(own)
        out_nodes.append(np.full(len(own), node))
    return np.concatenate(out_keys), np.concatenate(out_nodes)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def near(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    return large - small <= NEAR * small and len(a) + len(b) - 2 * overlap(a, b) <= NEAR * small


def may_link(points: np.ndarray, sizes: np.ndarray, at: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Whether the count-vector bound lets sets link to a set of size n at
    point ``at``, or to a set that one of the two leads."""
    return reaches(np.minimum(points, at).sum(axis=1), sizes, n, percent)


def reaches(bound: np.ndarray, sizes: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Whether an overlap of ``bound`` is enough.  Two leaders stand for sets
    that differ from them in at most ``NEAR`` of their shingles each: that takes at
    most 2 * NEAR from the overlap and adds as much to the sum of the sizes."""
    room = 3 * NEAR * np.minimum(sizes, n)
    return (bound + room) * (100 + percent) >= percent * (sizes + n)


def dims_of(n: int) -> int:
    """Groups of the point of a set of n shingles: with fewer than three
    shingles to a group, points of unrelated sets have little in common."""
    return int(2 ** np.clip(np.ceil(np.log2(max(1, n) / 3)), np.log2(COARSE), 14))


def folded(points: np.ndarray, dims: int) -> np.ndarray:
    """Points (one or a matrix of them) in fewer groups: neighbours are added."""
    return points.reshape(*points.shape[:-1], dims, -1).sum(axis=-1)


def point(s: np.ndarray, dims: int) -> np.ndarray:
    """Shingle counts of ``dims`` groups (a power of two)."""
    place = (s & np.uint64(0xFFFFFFFF)) * np.uint64(dims) >> np.uint64(32)
    return np.bincount(place.astype(np.int64), minlength=dims).astype(np.int32)


def point_bytes(s: np.ndarray) -> bytes:
    """The point in ``dims_of`` groups, byte planes apart (the upper one is
    mostly zero and compresses away; no group holds 65,536 of so few shingles)."""
    return point(s, dims_of(len(s))).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def point_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(2, -1).T.copy().view("<u2")[:, 0].astype(np.int32)


def shared_keys(docs: DataFrame, text_col: str, percent: int, words: int = N) -> DataFrame:
    """(run, node, long): the sets that share a key.  Runs of few sets are named
    by their sets, so that the many keys that two copies share are one run."""
    def emit(batches):
        found, held = [], 0
        seen: set[int] = set()                       # sets this task has already sent

        def sent():
            keys, nodes = thinned(found)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes)],
                                              names=["key", "node"])

        for batch in parts_of(batches):
            for text in batch.column(0).to_pylist():
                s = shingles(text, words)
                if not len(s):
                    continue
                node = fingerprint(s)[0]
                if node in seen:
                    continue
                if len(seen) < SEEN_SETS:
                    seen.add(node)
                found.append((node, s, group_rows(s, percent)))
                held += len(s)
                if held >= FLUSH_ROWS:
                    yield sent()
                    found, held = [], 0
        if found:
            yield sent()

    def meet(batches):
        """Rows come sorted by key and node.  Only keys of several sets go on;
        a key of more than SHORT_RUN rows keeps its name, its rows stream."""
        held, long_key = None, None

        def runs(keys, nodes):
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
            keys, nodes = keys[new], nodes[new]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(first, len(keys)))
            name = np.repeat(mix(np.add.reduceat(mix(nodes.view(np.uint64) + _K[1]), first)).view(np.int64), sizes)
            name = np.where(np.repeat(sizes > SHORT_RUN, sizes), keys, name)
            several = np.repeat(sizes > 1, sizes)
            is_long = np.repeat(sizes > SHORT_RUN, sizes)[several]
            rows, at = np.unique(np.stack([name[several], nodes[several]], axis=1), axis=0, return_index=True)
            return batch_of(rows[:, 0], rows[:, 1], is_long[at])

        def batch_of(keys, nodes, is_long):
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes), pa.array(is_long)],
                                              names=["run", "node", "long"])

        for batch in batches:
            keys, nodes = (batch.column(i).to_numpy() for i in (0, 1))
            if held is not None:
                keys, nodes = np.concatenate([held[0], keys]), np.concatenate([held[1], nodes])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            if long_key is not None:                 # the rest of a long run goes out as it comes
                n = int(np.searchsorted(keys, long_key, side="right"))
                if n:
                    yield batch_of(keys[:n], nodes[:n], np.ones(n, dtype=bool))
                keys, nodes, cut = keys[n:], nodes[n:], max(0, cut - n)
                long_key = None if len(keys) else long_key
            if cut:
                yield runs(keys[:cut], nodes[:cut])
            held = (keys[cut:], nodes[cut:])
            if len(held[0]) > 64 * SHORT_RUN and held[1][0] != held[1][-1]:
                long_key = held[0][0]
                yield batch_of(*held, np.ones(len(held[0]), dtype=bool))
                held = None
        if held is not None and len(held[0]):
            yield runs(*held)

    rows = arrow_map(docs.select(docs[text_col]), emit, "key long, node long")
    dealt = rows.repartition("key").sortWithinPartitions("key", "node")
    return arrow_map(dealt, meet, "run long, node long, long boolean").distinct()


def run_blocks(runs: DataFrame) -> DataFrame:
    """(run, i, j, block, node): a run of up to ``BLOCK_SETS`` sets is one
    group; a longer one (a passage that very many documents share) is dealt in
    blocks, and every pair of blocks is a group."""
    sizes = runs.where("long").groupBy("run").agg(
        F.ceil(F.count("*") / F.lit(float(BLOCK_SETS))).cast("int").alias("blocks"))
    short = runs.where("not long").select("run", "node", F.lit(1).alias("blocks"))
    placed = short.unionByName(runs.where("long").join(sizes, "run").select("run", "node", "blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return placed.select("run", "node", block.alias("block"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "run", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")


class Points:
    """Points of sets of different sizes, compared by the count-vector bound:
    first by size, then in ``COARSE`` groups, then in as many as both have."""

    def __init__(self, points: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.points, self.sizes, self.percent = points, sizes, percent
        self.dims = np.array([len(p) for p in points])
        self.coarse = np.stack([folded(p, COARSE) for p in points])

    def may_link(self, i: int, other: np.ndarray) -> np.ndarray:
        """Which of the sets ``other`` the bound does not keep apart from set i."""
        n, sizes = self.sizes[i], self.sizes
        other = other[reaches(np.minimum(sizes[other], n), sizes[other], n, self.percent)]
        other = other[may_link(self.coarse[other], sizes[other], self.coarse[i], n, self.percent)]
        found = []
        for dims in np.unique(self.dims[other]):
            own = other[self.dims[other] == dims]
            common = min(dims, self.dims[i])
            rows = np.stack([folded(self.points[k], common) for k in own])
            found.append(own[may_link(rows, sizes[own], folded(self.points[i], common), n, self.percent)])
        return np.concatenate(found) if found else other


def bound_links(nodes: list, sizes: np.ndarray, points: list[np.ndarray], blocks: np.ndarray, same: bool,
                percent: int) -> list:
    """Links that connect whatever the bound does not keep apart: inside one
    block, or from the smaller block number to the larger."""
    label, out, known = np.arange(len(nodes)), [], Points(points, sizes, percent)
    theirs = np.arange(len(nodes)) if same else np.flatnonzero(blocks != blocks.min())
    asking = theirs[1:] if same else np.flatnonzero(blocks == blocks.min())
    for i in asking:
        other = theirs[:i] if same else theirs
        for k in known.may_link(i, other[label[other] != label[i]]):      # sets already joined need no comparison
            if label[k] != label[i]:
                label[label == label[k]] = label[i]
                out.append((nodes[k], nodes[i]))
    return out


def family_links(docs: DataFrame, sets: DataFrame, text_col: str, percent: int, words: int = N) -> DataFrame:
    """(a, b): fingerprints (f1) of sets that share a key and that the
    count-vector bound does not keep apart."""
    def compare(batches):
        group, rows, pairs = None, [], []

        def done():
            if len(rows) < 2:
                return []
            block, nodes, sizes, points = zip(*rows)
            return bound_links(nodes, np.array(sizes), [point_of(p) for p in points], np.array(block),
                               group[1] == group[2], percent)

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                               pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in parts_of(batches):
            for run, i, j, *row in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if (run, i, j) != group:
                    pairs += done()
                    group, rows = (run, i, j), []
                rows.append(row)
            yield batch_of()
            pairs = []
        pairs += done()
        yield batch_of()

    runs = staged(shared_keys(docs, text_col, percent, words), "runs")
    points = sets.groupBy("f1").agg(F.min(F.struct("n", "point")).alias("p"))
    grouped = run_blocks(runs)
    rows = grouped.join(points, grouped["node"] == points["f1"]).select(
        "run", "i", "j", "block", "node", "p.n", "p.point")
    dealt = rows.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j", "node")
    return arrow_map(dealt, compare, "a long, b long")


# -- the tree -----------------------------------------------------------------
class CountTree:
    """Packed R-tree over group-count points.  Nodes keep the upper corner of
    their box and the smallest and largest set size below them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        sizes = np.array([len(s) for s in sets])
        self.dims = int(2 ** np.clip(np.round(np.log2(max(1.0, np.median(sizes)) / 3)), 4, 10))
        points = np.stack([point(s, self.dims) for s in sets])
        # Sort-tile packing: by size, then inside slabs of LEAF * LEAF points
        # by the coordinates that vary most.
        wide = np.argsort(-points.var(axis=0), kind="stable")[:4]
        slab = np.empty(len(sets), dtype=np.int64)
        slab[np.argsort(sizes, kind="stable")] = np.arange(len(sets)) // (LEAF * LEAF)
        self.order = np.lexsort((*[points[:, d] for d in wide[::-1]], slab))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []                             # from the leaves upwards
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > 1:
            cut = np.arange(0, len(top), LEAF)
            top, low, high = (np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(low, cut),
                              np.maximum.reduceat(high, cut))
            self.levels.append((top, low, high))

    def _may_link(self, at: np.ndarray, n: int, corner, low, high) -> np.ndarray:
        """overlap >= percent/(100+percent) * (sum of sizes), with the bound
        for the overlap and the smallest partner size that fits."""
        small = np.maximum(low, -(-n * self.percent // 100))
        fits = (small <= high) & (small * self.percent <= n * 100)
        bound = np.minimum(corner, at).sum(axis=1)
        return fits & (bound * (100 + self.percent) >= self.percent * (n + small))

    def search(self, s: np.ndarray) -> np.ndarray:
        """Indices (into the given sets) of all points that may link to s."""
        at, n = point(s, self.dims), len(s)
        found = np.arange(1 if self.levels else len(self.points))
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[k]
            found = found[self._may_link(at, n, top[found], low[found], high[found])]
            below = len(self.levels[k - 1][0]) if k else len(self.points)
            found = (found[:, None] * LEAF + np.arange(LEAF)).ravel()
            found = found[found < below]
        keep = self._may_link(at, n, self.points[found], self.sizes[found], self.sizes[found])
        return self.order[found[keep]]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def family_pairs(ids, sets, blocks, same: bool, percent: int):
    """Links that connect what is linked: inside one block (``same``), or
    from the sets of the smaller block number to those of the larger."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = min(blocks)
    indexed = [i for i in range(len(ids)) if same or blocks[i] != first]
    asking = [i for i in range(len(ids)) if same or blocks[i] == first]
    if not indexed or not asking:
        return []
    tree, out = CountTree([sets[i] for i in indexed], percent), []
    for q in asking:
        for k in tree.search(sets[q]):
            p = indexed[k]
            if (not same or p > q) and root(p) != root(q) and linked(sets[p], sets[q], percent):
                parent[root(p)] = root(q)
                out.append((ids[q], ids[p]))
    return out


def verified_links(docs: DataFrame, members: DataFrame, id_col: str, text_col: str,
                   percent: int, words: int = N) -> DataFrame:
    """(a, b): verified links between representatives; ``members`` has doc
    (representative id), n and family."""
    sizes = members.groupBy("family").agg(F.count("*").alias("c"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_SETS),
                        F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    placed = members.join(sizes.select("family", blocks.alias("blocks")), "family").select(
        "doc", "family", "blocks", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("block"))
    texts = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text"))
    placed = staged(placed, "placed")
    texts = placed.join(maybe_in(texts, "doc", placed.select("doc")), "doc")

    def read(batches):
        for batch in parts_of(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(4)]
                + [pa.array([shingles(t, words).tobytes() for t in batch.column(4).to_pylist()], pa.binary())],
                names=["doc", "family", "blocks", "block", "set"])

    sets = arrow_map(texts.select("doc", "family", "blocks", "block", "text"), read,
                     "doc long, family long, blocks int, block int, set binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (sets.withColumn("other", other)
             .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "doc", "set")
             .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "doc"))

    def compare(batches):
        group, ids, own, blocks_of = None, [], [], []

        def done():
            pairs = family_pairs(ids, own, blocks_of, group[1] == group[2], percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                               pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in parts_of(batches):
            for f, i, j, block, doc, raw in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if (f, i, j) != group:
                    if ids:
                        yield done()
                    group, ids, own, blocks_of = (f, i, j), [], [], []
                ids.append(doc)
                own.append(np.frombuffer(raw, dtype=np.uint64))
                blocks_of.append(block)
        if ids:
            yield done()

    return arrow_map(dealt, compare, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       percent: int = PERCENT, words: int = N) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id; texts are
    linked whose sets of ``words``-word shingles reach ``percent``."""
    sets = staged(sets_of(docs, id_col, text_col, words), "sets")
    own = sets.where("doc is not null and n > 0")
    reps = staged(own.groupBy("f1", "f2").agg(F.min("doc").alias("rep"), F.first("n").alias("n")), "set-reps")
    families = staged(components(family_links(docs.where(docs[id_col].isNotNull()), own, text_col, percent, words))
                      .select(F.col("node").alias("f1"), F.col("component").alias("family")), "families")
    members = staged(reps.join(families, "f1").select(F.col("rep").alias("doc"), "n", "family"), "members")
    links = verified_links(docs, members, id_col, text_col, percent, words)
    # An id that came with several texts joins their classes.
    several = own.groupBy("doc").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("f1", "f2")
                                       for f in (F.min, F.max)])
    several = several.where("min_f1 != max_f1 or min_f2 != max_f2").select("doc")
    across = (own.join(several, "doc", "left_semi").join(reps, ["f1", "f2"]).where("doc != rep")
              .select(F.col("doc").alias("a"), F.col("rep").alias("b")))
    found = components(links.unionAll(across)).withColumnRenamed("node", "rep")
    named = staged(reps.join(found, "rep", "left").select(
        "f1", "f2", F.coalesce("component", "rep").alias("component")), "set-components")
    return sets.join(named, ["f1", "f2"], "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
meets AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM meets JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM words
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM words w JOIN reach r ON r.x = w.doc_id LEFT JOIN sizes s ON s.doc_id = w.doc_id
GROUP BY w.doc_id, n
"""
