"""Similarity joins and components against brute force."""

import random

import numpy as np
import pytest
from edge import DOCS, as_dict, docs, empty, odd_texts

from fraudlens.llm import op10_jaccard_join as jac
from fraudlens.llm.components import components


def closure(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    return [len(s) for s in sets], closure(len(sets), links)


def near_copies(seed, bases, copies, words=(5, 160)):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(55)]
    texts = []
    for b in range(bases):
        base = [rng.choice(vocab) for _ in range(rng.randint(*words))]
        if b % 3 == 0:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [2_000, 7])
def test_jaccard_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jac, "BLOCK_SETS", block)
    monkeypatch.setattr(jac, "SHORT_RUN", 64 if block > 100 else 3)
    texts = near_copies(1, 40, 8) + near_copies(2, 1, 60, (90, 90))
    texts += ["A b", "a B", "a b c", None, "", " \n", texts[0], texts[0].upper(), "x " * 9, "x  x\tx x x"]
    sizes, want = brute(texts)
    got = as_dict(jac.jaccard_components(docs(spark, texts, extra={"n": 1, "f1": "x", "doc": 3})))
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert (got[i].n_shingles, got[i].component_id) == (sizes[i], want[i]), (i, texts[i])


def test_linked_sets_share_a_key():
    rng, n_pairs = np.random.default_rng(4), 0
    for _ in range(3_000):
        n = int(rng.choice([rng.integers(1, 12), rng.integers(7, 45), rng.integers(28, 80), rng.integers(60, 400)]))
        pool = rng.integers(0, 1 << 64, 2 * n, dtype=np.uint64)
        a = np.unique(pool[:n])
        gone, new = rng.integers(0, int(0.16 * n) + 2, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], pool[n:n + new]]))
        if len(b) and jac.linked(a, b, 85):
            n_pairs += 1
            assert len(np.intersect1d(jac.group_rows(a, 85), jac.group_rows(b, 85)))
    assert n_pairs > 500


def test_tree_search_loses_no_link():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 64, rng.integers(5, 300), dtype=np.uint64)) for _ in range(120)]
    sets = [np.unique(np.concatenate([rng.permutation(s)[int(len(s) * rng.uniform(0, .1)):], s[:1]]))
            for s in base for _ in range(12)]
    tree, far = jac.CountTree(sets, 85), 0
    for i in range(0, len(sets), 7):
        found = set(tree.search(sets[i]).tolist())
        assert {j for j in range(len(sets)) if jac.linked(sets[i], sets[j], 85)} <= found
        far += len(found)
    assert far < 0.1 * len(sets) * len(range(0, len(sets), 7))


def test_jaccard_odd_rows(spark):
    texts = [t for t in odd_texts()]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rows += [(None, "p q r s t u", "en", "s", 0), (None, None, None, None, None)]
    rows += [(500, "p q r s t u", "en", "s", 0), (501, "p q r s t u", None, None, None)]
    rows += [(600, "only here one two", "en", "s", 0), (600, "and there three four", "en", "s", 0),
             (601, "only here one two", "en", "s", 0), (602, "and there three four", "en", "s", 0)] * 2
    got = jac.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert (by[500].component_id, by[501].component_id) == (500, 500)
    assert {by[i].component_id for i in (600, 601, 602)} == {600}
    assert by[0].n_shingles == 0 and by[0].component_id == 0
    assert jac.jaccard_components(empty(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(6)
    nodes = list(range(0, 4_000, 4))
    links = [(nodes[i], nodes[i + 1]) for i in range(199)]                    # a path of 200
    links += [(nodes[300], n) for n in nodes[301:700]]                        # a star
    links += [(rng.choice(nodes[700:]), rng.choice(nodes[700:])) for _ in range(150)]
    links += [(5, 5), links[0], (None, 3)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = closure(4_000, real)
    touched = {x for link in real for x in link}
    assert set(got) == touched and all(got[x] == want[x] for x in touched)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def cosine_brute(vectors, cosine=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for v in vectors]
    x = [np.array(v, float) / np.linalg.norm(v) if g else None for v, g in zip(vectors, ok)]
    links = [(i, j) for i in range(len(x)) for j in range(len(x)) if i != j and ok[i] and ok[j]
             and len(x[i]) == len(x[j]) and x[i] @ x[j] >= cosine]
    degree = np.zeros(len(x), int)
    for i, _ in links:
        degree[i] += 1
    return degree, closure(len(x), links)


def vectors_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")


@pytest.mark.parametrize("block", [1_024, 16])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    from fraudlens.llm import op5_embedding_dedup as emb
    monkeypatch.setattr(emb, "BLOCK", block)
    monkeypatch.setattr(emb, "HOT_ROWS", 16)
    rng = np.random.default_rng(7)
    base = rng.standard_normal((60, 32))
    near = [b + rng.standard_normal(32) * s for b in base[:25] for s in (0.05, 0.2, 0.3)]
    hot = [base[0] + rng.standard_normal(32) * 0.05 for _ in range(150)]
    rows = [v.astype(np.float32).tolist() for v in [*base, *near, *hot]]
    rows += [rows[0], rows[0], [2 * x for x in rows[3]], [-x for x in rows[3]]]
    rows += [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [float("inf")] * 32,
             [1.0, 0.0], [2.0, 0.1], [3e38] * 32, [3.0] * 32, [1e-40] * 32]
    got = as_dict(emb.near_duplicates(vectors_table(spark, [(i, v, i % 3, 1) for i, v in enumerate(rows)])), "vec_id")
    degree, root = cosine_brute(rows)
    assert len(got) == len(rows)
    for i in range(len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (degree[i], root[i], root[i] == i), i


def test_embedding_recall_at_the_limit():
    """Pairs exactly at cosine 0.9 meet in a bucket and pass the sketch."""
    from fraudlens.llm import op5_embedding_dedup as emb
    rng = np.random.default_rng(8)
    k, tables = emb.plan(50_000)
    hasher = emb.Hasher(64, k, tables)
    x = emb.unit(rng.standard_normal((1_500, 64)))
    y = rng.standard_normal((1_500, 64))
    y = emb.unit(y - (y * x).sum(axis=1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * y
    met = (hasher.keys(x) == hasher.keys(y)).any(axis=1)
    alike = emb.differ(hasher.sketches(x), hasher.sketches(y)) <= emb.SKETCH_LIMIT
    assert (met & alike).mean() > 0.93 and alike.mean() > 0.999


def test_embedding_odd_tables(spark):
    from fraudlens.llm import op5_embedding_dedup as emb
    assert emb.near_duplicates(vectors_table(spark, [])).count() == 0
    same = [1.0, 2.0, 3.0]
    got = emb.near_duplicates(vectors_table(spark, [(1, same, 0, 0), (1, same, 0, 0), (None, same, 0, 0),
                                                    (4, same, 0, 0), (5, None, None, None)])).collect()
    assert len(got) == 5
    assert sorted(r.n_links for r in got) == [0, 0, 2, 2, 2]
    assert {r.component_id for r in got if r.vec_id in (1, 4)} == {1}
    assert [r.component_id for r in got if r.vec_id is None] == [None]


def test_maybe_in_splits_without_loss(spark):
    from fraudlens.llm.common import maybe_in
    rows = spark.range(5_000).selectExpr("if(id = 7, null, id) as doc_id", "'t' as word", "id as bits")
    ids = spark.range(0, 5_000, 50).selectExpr("id as d")
    inside, outside = (maybe_in(rows, "doc_id", ids, side).toPandas() for side in (True, False))
    assert len(inside) + len(outside) == 5_000 and list(inside.columns) == ["doc_id", "word", "bits"]
    assert set(range(0, 5_000, 50)) <= set(inside["doc_id"].dropna()) and len(inside) < 130
    assert maybe_in(rows, "doc_id", ids.limit(0)).count() == 0


def test_bound_of_families_keeps_every_link_and_parts_unrelated_sets():
    """Near copies, also through a leader each, pass the bound at every size;
    unrelated sets do not, however large, nor with half their content shared."""
    rng = np.random.default_rng(8)
    draw = lambda k: np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64))
    for n in (40, 190, 200, 700, 1_500, 3_000, 12_000):
        for percent in (80, 85):
            s, passage = draw(n), draw(n // 3)
            others = [np.sort(np.concatenate([s[:int(n * percent / 100) + 1], draw(k)])) for k in (0, n // 100)]
            led = [np.sort(np.concatenate([x[:len(x) - int(jac.NEAR * len(x) / 2)], draw(int(jac.NEAR * len(x) / 2))]))
                   for x in others if len(x)]
            far = [draw(n), draw(int(n * 1.1)), np.concatenate([passage, draw(n - len(passage))])]
            sets = [s, *others, *led, *far, np.concatenate([passage, draw(n - len(passage))])]
            known = jac.Points([jac.point_of(jac.point_bytes(x)) for x in sets], np.array([len(x) for x in sets]), percent)
            found = set(known.may_link(0, np.arange(1, len(sets))).tolist())
            linked = {k for k in range(1, len(sets)) if jac.linked(s, sets[k], percent)}
            assert linked <= found and 3 in found
            if n >= 190:
                assert not found & {5, 6, 7, 8}
                assert not known.may_link(8, np.arange(8)).size          # a third is shared with one of them
