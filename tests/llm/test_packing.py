"""Sequence packing: every piece once, gapless, in few sequences."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import DOCS, PLAIN, docs, empty, odd_texts

from fraudlens.llm import bpe
from fraudlens.llm import op13_sequence_packing as pk


def least(sizes, capacity):
    """Fewest bins by exhaustive search (few pieces)."""
    best, sizes = len(sizes), sorted(sizes, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            k = rooms.index(room)
            place(i + 1, rooms[:k] + [room - sizes[i]] + rooms[k + 1:])
        place(i + 1, rooms + [capacity - sizes[i]])
    place(0, [])
    return best


def checked(counts, capacity):
    packing = pk.configurations(counts, capacity)
    used = Counter()
    for k, made in packing:
        assert k > 0 and sum(n * m for n, m in made) <= capacity
        for n, m in made:
            used[n] += k * m
    assert used == Counter({n: c for n, c in counts.items() if c})
    return sum(k for k, _ in packing)


def test_knapsack_against_enumeration():
    rng = random.Random(1)
    for _ in range(30):
        capacity, m = rng.randint(5, 24), rng.randint(1, 4)
        lengths = np.array(sorted(rng.sample(range(1, capacity + 1), m)))
        weights = np.array([rng.random() * n for n in lengths])
        value, choice = pk.knapsack(lengths, weights, capacity)
        for c in range(capacity + 1):
            ways = itertools.product(*[range(c // n + 1) for n in lengths])
            best = max(sum(k * w for k, w in zip(way, weights)) for way in ways
                       if sum(k * n for k, n in zip(way, lengths)) <= c)
            assert value[c] == pytest.approx(best)
            made = pk._fill(choice, lengths, c)
            assert sum(n * k for n, k in made) <= c
            of = dict(zip(lengths.tolist(), weights))
            assert sum(of[n] * k for n, k in made) == pytest.approx(best)


def test_small_instances_against_exhaustive_search():
    rng = random.Random(2)
    gap = 0
    for _ in range(25):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        found, best = checked(Counter(sizes), 20), least(sizes, 20)
        assert best <= found <= best + 1
        gap += found - best
    assert gap <= 2


def test_many_pieces_close_to_the_bound_and_not_worse_than_best_fit():
    rng = np.random.default_rng(3)
    for lengths, gain in ([101, 118, 150, 203, 210, 251, 327, 350], 1.001), (range(75, 275, 3), 0.985):
        counts = Counter(rng.choice(lengths, 40_000).tolist())
        assert checked(counts, 512) <= gain * sum(k for k, _ in pk.best_fit(counts, 512))
    counts = Counter(np.clip(rng.lognormal(4, 1, 60_000), 1, 512).astype(int).tolist())
    bound = -(-sum(n * c for n, c in counts.items()) // 512)
    assert checked(counts, 512) <= 1.005 * bound
    assert checked({512: 5}, 512) == 5 and checked({}, 512) == 0 and checked({1: 1}, 512) == 1
    with pytest.raises(ValueError):
        pk.configurations({513: 1}, 512)


@pytest.mark.parametrize("capacity,parts", [(2048, 5), (64, 7), (1, 3)])
def test_documents(spark, capacity, parts):
    texts = [t for t in odd_texts() if capacity > 64 or t is None or len(t) < 5_000]
    texts += [PLAIN[:k] for k in range(1, 60)] * 2 + [PLAIN * 60] * 3
    random.Random(4).shuffle(texts)
    df = docs(spark, texts, first=2, extra={"piece": "x", "sequence_id": 1, "__rank": 0}).repartition(parts)
    packed = pk.pack(df, capacity=capacity, ids=True, keep=["doc_id"])
    rows = packed.collect()
    library = bpe.Encoder(bpe.default_path()).tokenizer
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(range(2, 2 + len(texts)))
    for i, text in enumerate(texts, 2):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        assert all(r.length == capacity for r in own[1:]) and sum((r.ids for r in own), []) == ids
        at = 0
        for r in own:
            assert (r.start, r.length) == (at, len(r.ids))
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            at += r.length
    whole = {r.sequence_id: r.ids for r in pk.sequences(packed).collect()}
    for s, own in by_sequence.items():
        own.sort(key=lambda r: r.offset)
        ends = [0, *itertools.accumulate(r.length for r in own)]
        assert [r.offset for r in own] == ends[:-1] and ends[-1] <= capacity
        assert whole[s] == sum((r.ids for r in own), [])
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= max(1.02 * total / capacity + 1, sum(r.length > capacity / 2 for r in rows))


def test_odd_tables(spark):
    assert pk.pack(empty(spark)).count() == 0
    rows = [(None, "a", "", "", 0), (5, "b", "", "", 0), (5, None, "", "", 0), (5, "b", "", "", 0)]
    got = pk.pack(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 2), (5, 1), (5, 2), (5, 2)]
    got.sort(key=lambda r: r.offset)
    assert {r.sequence_id for r in got} == {got[0].sequence_id}
    assert [r.offset for r in got] == [0, *itertools.accumulate(r.length for r in got[:-1])]
    assert set(DOCS.names) < set(got[0].asDict())
