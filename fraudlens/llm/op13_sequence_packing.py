"""Best-fit packing by a configuration linear program.

Every text is encoded once, cut into pieces of at most ``capacity`` tokens
(only texts that are longer; the first piece may be shorter) and counted by
length.  The histogram of lengths, at most ``capacity`` numbers however large the corpus,
is all that the program sees.

Program: a configuration says how many pieces of each length share a
sequence; use each configuration c for x_c sequences so that all pieces are
covered and the sum of x is least.  Multiplicative weights solve it: each length has a
weight that falls as its pieces are covered; a knapsack dynamic program over the
capacity prices the configurations (the most weight that fits, and the most
that fits beside a given length), those near the best price get a step of use,
the lengths most behind first, and the weights are updated.  A first run
only learns weights, the next starts from them.  The solution is
rounded to whole sequences that use no piece twice; what is left is solved
and rounded again within a fixed number of dynamic programs (some ten seconds at
any corpus size), and the last remainder is packed best fit, largest first.

Placement: pieces of one length are interchangeable, so the packing is a table
of runs: ranks [r, r + k * m) of a length go to k sequences with m places each.
A piece's rank is its number within its task (given while encoding) plus the pieces of
that length in earlier tasks (a running sum over one row per task and length), so no
length, however frequent, is gathered or sorted anywhere.  The table of runs has a size
bound by the capacity and the number of configurations, and is broadcast.

Defined cases: a null text is the empty one, one piece with the end token
alone; repeated rows and null ids are rows of their own; texts of any length are encoded
whole; an empty table gives an empty result; an input column named like an
output is replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm import bpe
from fraudlens.llm.common import TEXT, arrow_map, parts_of, shared_dir, table

CAPACITY = 2048
ROUNDS, PHASE_ROUNDS = 240, 120      # dynamic programs in all, and until the solution is rounded
WARM = 100                   # dynamic programs that only learn the first weights
COVER = 0.05                 # a step covers at most this share of any length
NEAR_BEST = 0.97             # of the best price: configurations that get a step
STEEP = 2.0                  # how fast a weight falls with coverage
SLACK = 0.03                 # share of the tokens that a phase leaves to the next
PIECES = "piece int, start long, length long, ids_crc32 long"
PLACES = {"sequence_id": "long", "offset": "long"}
PART, RANK = "__part", "__rank"

Configuration = tuple[tuple[int, int], ...]      # (length, how many), longest first


# -- the linear program -------------------------------------------------------
def knapsack(lengths: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, choice): the most weight within each capacity and the index of
    the length that was put in last (-1: none); lengths ascending, any number of each."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fits[c]
        value[c], choice[c] = value[c - 1], -2           # -2: one place left empty
        if k:
            sums = value[c - lengths[:k]] + weights[:k]
            best = int(sums.argmax())
            if sums[best] > value[c]:
                value[c], choice[c] = sums[best], best
    return value, choice


def _fill(choice: np.ndarray, lengths: np.ndarray, room: int, first: int | None = None) -> Configuration:
    """The configuration that the dynamic program found for ``room`` places,
    beside one piece of the length ``first``."""
    used: dict[int, int] = {}
    if first is not None:
        used[int(lengths[first])] = 1
        room -= int(lengths[first])
    while room > 0 and choice[room] != -1:
        if choice[room] == -2:
            room -= 1
            continue
        n = int(lengths[choice[room]])
        used[n] = used.get(n, 0) + 1
        room -= n
    return tuple(sorted(used.items(), reverse=True))


def fractional(counts: dict[int, int], capacity: int, rounds: int,
               learned: dict[int, float]) -> tuple[dict[Configuration, float], int]:
    """(uses x_c, rounds taken): multiplicative weights until the pieces'
    tokens are covered but for ``SLACK``, or the rounds are used up (what is not
    covered by then is left for the next phase).  ``learned`` holds the
    logarithms of the weights per token, from which the run starts and which it updates."""
    lengths = np.array(sorted(counts))
    demand = np.array([counts[int(n)] for n in lengths], dtype=float)
    share = lengths * demand / (lengths * demand).sum()
    at = {int(n): i for i, n in enumerate(lengths)}
    before = np.array([learned.get(int(n), 0.0) for n in lengths])
    covered, used, taken = np.zeros(len(lengths)), {}, 0
    while taken < rounds and (np.minimum(covered, 1) * share).sum() < 1 - SLACK:
        taken += 1
        mean = (covered * share).sum()
        wanted = covered < 1 + COVER                     # the rest has no weight any more
        own_lengths = lengths[wanted]
        weights = own_lengths * np.exp(before[wanted] + STEEP * (mean - covered[wanted]))
        value, choice = knapsack(own_lengths, weights, capacity)
        price = weights + value[capacity - own_lengths]
        near_best = np.flatnonzero(price >= NEAR_BEST * value[capacity])
        first = True
        for i in near_best[np.argsort(covered[wanted][near_best], kind="stable")]:     # the most behind first
            made = _fill(choice, own_lengths, capacity, int(i))
            own = np.array([at[n] for n, _ in made])
            if not first and covered[own].max() > mean + 2 * COVER:                    # priced before its last steps
                continue
            many, first = np.array([m for _, m in made], dtype=float), False
            step = COVER * (demand[own] / many).min()
            used[made] = used.get(made, 0.0) + step
            covered[own] += step * many / demand[own]
    learned.update(zip(lengths.tolist(), (before + STEEP * ((covered * share).sum() - covered)).tolist()))
    return used, taken


def rounded(used: dict[Configuration, float], left: dict[int, int]) -> list[tuple[int, Configuration]]:
    """Whole uses that keep the running total of x, most used first, none
    beyond the pieces that are left (``left`` is lowered)."""
    out, total = [], 0.0
    for made, x in sorted(used.items(), key=lambda u: (-u[1], u[0])):
        k, total = int(total + x) - int(total), total + x
        k = min([k, *[left[n] // m for n, m in made]])
        if k:
            out.append((k, made))
            for n, m in made:
                left[n] -= k * m
    return out


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Configuration]]:
    """Best fit, largest first, on a histogram: equal sequences are one class,
    so the work does not grow with the number of pieces."""
    classes: dict[int, list[tuple[int, Configuration]]] = {}     # by the room that is left

    def put(k: int, room: int, made: Configuration) -> None:
        if k:
            classes.setdefault(room, []).append((k, made))

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r, own in classes.items() if own and r >= n), default=None)
            if room is None:
                room, made, each = capacity, (), capacity // n
                k = -(-left // each)
            else:
                (k, made), each = classes[room].pop(), room // n
            full = min(k, left // each)
            put(full, room - each * n, (*made, (n, each)))
            left -= full * each
            if full < k and left:                                # one more takes the rest
                put(1, room - left * n, (*made, (n, left)))
                full, left = full + 1, 0
            put(k - full, room, made)
    return [c for own in classes.values() for c in own]


def configurations(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Configuration]]:
    """(k, configuration): k sequences of each; together they hold every piece
    of the histogram exactly once."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece has from 1 to capacity tokens")
    out = [(left.pop(capacity), ((capacity, 1),))] if capacity in left else []
    rounds, learned = ROUNDS, {}
    if left:                                             # weights only: its uses are those of a start from nothing
        fractional(left, capacity, WARM, learned)
    while left and rounds > 0:
        used, taken = fractional(left, capacity, min(rounds, PHASE_ROUNDS), learned)
        whole, rounds = rounded(used, left), rounds - taken
        left = {n: c for n, c in left.items() if c}
        out += whole
        if not whole:
            break
    return out + best_fit(left, capacity)


def run_table(packing: list[tuple[int, Configuration]]) -> dict[str, np.ndarray]:
    """Runs sorted by (length, first rank): pieces of that length from that
    rank on take ``each`` places in every sequence from ``sequence`` on, the
    first at ``offset``."""
    rows, next_rank, sequence = [], {}, 0
    for k, made in packing:
        offset = 0
        for n, m in made:
            rows.append((n, next_rank.get(n, 0), m, sequence, offset))
            next_rank[n] = next_rank.get(n, 0) + k * m
            offset += n * m
        sequence += k
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "each", "sequence", "offset"), columns))


def places(runs: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence_id, offset) of the pieces with these lengths and ranks."""
    order = np.int64(1) << 48
    at = np.searchsorted(runs["length"] * order + runs["rank"], length * order + rank, side="right") - 1
    nth = rank - runs["rank"][at]
    each = runs["each"][at]
    return runs["sequence"][at] + nth // each, runs["offset"][at] + (nth % each) * length


# -- pieces -------------------------------------------------------------------
def piece_sizes(n: int, capacity: int) -> list[int]:
    if n <= capacity:
        return [n]
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY,
           end_id: int = 0, ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per piece: ``docs``' columns, ``PIECES``, with ``ids`` its token
    ids, and where it lies (``PART``, ``RANK`` among the task's pieces of its length).
    Store it before use: the numbers are those of the tasks that wrote it."""
    file, end = tokenizer or bpe.default_path(), end_id.to_bytes(4, "little")
    made_schema = T.StructType.fromDDL(PIECES + ", ids array<int>" * ids + f", {PART} int, {RANK} long")
    names = set(made_schema.names) | set(PLACES)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*kept, docs[text_col].alias(TEXT))
    schema = T.StructType([source.schema[c] for c in kept] + list(made_schema))

    def cut(batches):
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), bpe.encoder(file)
        seen = np.zeros(capacity + 1, dtype=np.int64).tolist()
        for batch in parts_of(batches):
            of, rows = [], []
            for i, text in enumerate(batch.column(len(kept)).to_pylist()):
                raw, start = enc.encode(text or "") + end, 0
                for nth, size in enumerate(piece_sizes(len(raw) // 4, capacity)):
                    own = raw[start * 4:(start + size) * 4]
                    of.append(i)
                    rows.append((nth, start, size, zlib.crc32(own),
                                 *([np.frombuffer(own, "<i4")] if ids else []), part, seen[size]))
                    seen[size] += 1
                    start += size
            left = [batch.column(k).take(pa.array(of, pa.int64())) for k in range(len(kept))]
            columns = list(zip(*rows)) or [()] * len(made_schema)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                     *([pa.list_(pa.int32())] if ids else []), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                left + [pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

    return arrow_map(source, cut, schema)


def pack(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY,
         end_id: int = 0, ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per piece with its sequence_id and offset: the pieces of one
    sequence fill it gapless from 0."""
    spark = docs.sparkSession
    made = pieces(docs, text_col, tokenizer, capacity, end_id, ids, keep)
    path = shared_dir(spark, "pieces")
    made.write.option("compression", "zstd").parquet(path)
    cut = spark.read.schema(made.schema).parquet(path)
    by_task = cut.groupBy(PART, "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = run_table(configurations(counts, capacity))           # from at most ``capacity`` numbers
    before = Window.partitionBy("length").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select(PART, "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(earlier, [PART, "length"]).select(
        *[c for c in cut.columns if c not in (PART, RANK)], (F.col(RANK) + F.col("earlier")).alias(RANK))
    names = [c for c in ranked.columns if c != RANK]
    schema = T.StructType([*[ranked.schema[c] for c in names],
                           *[T.StructField(c, T.LongType()) for c in PLACES]])
    shared = spark.sparkContext.broadcast(runs)

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", RANK))
            made = places(shared.value, length, rank) if len(rank) else (rank, rank)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *map(pa.array, made)],
                                             names=schema.names)

    return arrow_map(ranked, place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, from a ``pack``
    with ``ids``.  A group is one sequence, at most ``capacity`` ids."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("ids"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
