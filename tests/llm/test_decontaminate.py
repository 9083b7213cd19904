"""Decontamination against a brute-force version."""

import hashlib
import random
import re

import pytest
from edge import PLAIN, as_dict, docs, empty, odd_texts
from pyspark.sql import types as T

from fraudlens.llm.op2_decontaminate import OUTPUTS, decontaminate

BENCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
ALL = tuple(OUTPUTS)


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        for i in range(max(1, len(w) - 9) if w else 0):
            g = w[i:i + 10]
            for at in range(len(own) - len(g) + 1):
                if own[at:at + len(g)] == g:
                    hit.update(range(at, at + len(g)))
                    found.add("null" if item is None else str(item))
    return len(own), len(hit), sorted(found)


def random_case(seed, n=60):
    rng = random.Random(seed)
    vocab = ["a", "The", "dog", "é1", "漢", "x9", "of", "IT"]
    text = lambda k: rng.choice([" ", "\n", "-"]).join(rng.choice(vocab) for _ in range(k))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 14]))) for i in range(12)] + [(3, None), (None, "of of of")]
    texts = [text(rng.randint(0, 60)) for _ in range(n)] + [t for _, t in items] + odd_texts()
    return texts, items


@pytest.mark.parametrize("block_windows", [1_000_000, 4])
def test_equals_brute_force(spark, block_windows):
    texts, items = random_case(1)
    texts = [t for t in texts if t is None or len(t) < 2_000]
    got = as_dict(decontaminate(docs(spark, texts), spark.createDataFrame(items, BENCH), outputs=ALL,
                                block_windows=block_windows))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, n_hit, found = brute(t, items)
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r["items"]) == (n, n_hit, len(found), found), (i, t)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r.contaminated == (n_hit > 0)


def test_spans_are_cut(spark):
    bench = spark.createDataFrame([(7, PLAIN)], BENCH)
    got = as_dict(decontaminate(docs(spark, [f"Before, {PLAIN.upper()}! After.", "Clean é text"]), bench,
                                outputs=ALL))
    assert got[0].clean_text == "Before, ! After." and got[0].hit_spans == [[1, 20]]
    assert got[1].clean_text == "Clean é text" and not got[1].contaminated


def test_long_texts_are_scanned_whole(spark):
    bench = spark.createDataFrame([(1, PLAIN)], BENCH)
    long = "filler word " * 50_000
    got = as_dict(decontaminate(docs(spark, [long + PLAIN, long]), bench, outputs=("n_hit", "n_words")))
    assert (got[0].n_hit, got[1].n_hit, got[1].n_words) == (19, 0, 100_000)


def test_empty_tables_and_clashing_columns(spark):
    bench = spark.createDataFrame([], BENCH)
    assert decontaminate(empty(spark), bench).count() == 0
    got = decontaminate(docs(spark, [PLAIN, None], extra={"n_hit": "x", "gram": 1, "item": 2}), bench).collect()
    assert [r.n_hit for r in got] == [0, 0] and all(not r.contaminated and r.gram == 1 for r in got)
