"""Spelling variants against brute force."""

import random
import zlib

import pytest
from edge import DOCS, docs, empty, odd_texts

from fraudlens.llm import op11_spelling_variants as sv


def near(a: str, b: str) -> bool:
    """One letter replaced, or one inserted or deleted."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows):
    """Word counts of (id, text) rows, letter by letter."""
    counts = {}
    for i, text in rows:
        run, text = "", (text or "") + "\n"
        for c in text:
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= 7:
                    counts[run] = counts.get(run, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if n >= 2}


def brute_groups(counts):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [n, len(others), form, counts[form] if form else None, w]
    for w, row in out.items():
        while out[row[4]][2]:
            row[4] = out[row[4]][2]
    return {w: tuple(row) for w, row in out.items()}


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def vocabulary(seed, n, letters="abcdé", low=7, high=12):
    rng, words = random.Random(seed), set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
        words.add(w)
        for _ in range(rng.randint(0, 4)):
            at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            v = w[:at] + rng.choice(letters) * (kind != 0) + w[at + (kind != 1):]
            if len(v) >= 7:
                words.add(v)
    return {w: rng.choice([2, 3, 5, 30, 40, 400, 5_000, 60_000]) for w in sorted(words)}


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_near_words(seed):
    words = sorted(vocabulary(seed, 120, "ab" if seed % 2 else "abcdé", 7, 9))
    index = sv.PositionIndex(words)
    for w in words:
        replaced, extra, missing, _ = index.near(w)
        got = {v for k, v in enumerate(words) if (replaced | extra | missing) >> k & 1}
        assert got == {v for v in words if near(w, v)}


@pytest.mark.parametrize("letters,group", [("abcdé", 4_096), ("ab", 4_096), ("ab", 8), ("abcdé", 3)])
def test_groups_against_brute_force(spark, monkeypatch, letters, group):
    monkeypatch.setattr(sv, "GROUP_WORDS", group)              # small: keys are cut again
    counts = vocabulary(len(letters) + group, 400, letters, 7, 14 if group < 10 else 10)
    counts |= {"x" * 300: 2, "x" * 301: 90, "x" * 150 + "y" + "x" * 150: 7, "é" * 40: 3, "e" + "é" * 39: 50}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(sv.variant_groups(df)) == brute_groups(counts)


def test_documents_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sv, "TASK_WORDS", 40)
    rng = random.Random(5)
    words = [w for w in vocabulary(6, 60, "abcdefÀé") for _ in range(3)]
    texts = [" ".join(rng.choice(words).title() if rng.random() < .3 else rng.choice(words)
                      for _ in range(rng.randint(1, 400))) for _ in range(60)] + odd_texts()
    df = docs(spark, texts, first=5, extra={"word": "x", "n": 1, "key": 3}).repartition(5)
    counts = brute_counts(enumerate(texts, 5))
    assert {r.word: r.n for r in sv.word_counts(df).collect()} == counts
    assert found(sv.variant_groups(sv.word_counts(df))) == brute_groups(counts)


def test_odd_tables(spark):
    assert sv.variant_groups(sv.word_counts(empty(spark))).count() == 0
    text = "alphabet Alphabet alphabets ×÷Àÿéèê x"
    rows = [(None, text, "", "", 0), (3, text, "", "", 0), (3, text, "", "", 0), (4, None, "", "", 0)]
    df = spark.createDataFrame(rows, DOCS)
    want = brute_counts([r[:2] for r in rows])
    assert found(sv.variant_groups(sv.word_counts(df))) == brute_groups(want) and len(want) >= 3
