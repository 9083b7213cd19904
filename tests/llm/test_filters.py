"""Language ID and toxicity on held-out rows and edge cases."""

import math
import os
import zlib

import numpy as np
import pytest
from edge import as_dict, docs, empty, odd_texts

from fraudlens.llm import op6_toxicity as tox
from fraudlens.llm import op8_language_id as lid
from fraudlens.llm.common import held_out, table

SF = "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@needs_data
def test_language_accuracy_on_held_out(spark):
    found = lid.query(spark, SF).toPandas().merge(
        table(spark, SF, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(found) == 10_000 and found["score"].between(0, 1).all()
    expected = found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert (found["held_out"] == expected).all()
    held = found[found["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.995


@needs_data
def test_toxicity_on_held_out(spark):
    found = tox.query(spark, SF).toPandas()
    assert len(found) == 10_000 and found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= 0.7).astype(int)).all()
    held = found[found["held_out"]].merge(table(spark, SF, "labels").toPandas(), on="doc_id")
    y, rank = held["toxic"].to_numpy(), held["score"].rank().to_numpy()
    n = y.sum()
    assert (rank[y == 1].sum() - n * (n + 1) / 2) / n / (len(y) - n) > 0.95
    assert held["predicted"][y == 0].mean() < 0.01 and held["predicted"][y == 1].mean() > 0.85


def training(spark):
    en = ["the house and the garden are near the river", "this is what they said about the weather"]
    de = ["das haus und der garten sind nahe beim fluss", "das ist was sie sagten als der regen kam"]
    return docs(spark, en * 20).unionAll(docs(spark, de * 20, first=100, lang="de")).unionAll(
        docs(spark, ["x y"], first=200, lang=None))


def test_language_edge_cases(spark):
    filters = lid.learn(training(spark))
    assert set(filters.languages) == {"de", "en"}
    texts = odd_texts() + ["the garden", "der garten", "the weather " * 60_000, "1234 .,;"]
    got = as_dict(lid.identify(docs(spark, texts, extra={"score": "x", "rate": 1}), filters))
    n = len(odd_texts())
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (0, 1, 2, 3, n + 3)] == ["und"] * 5
    assert [got[n + i].lang_pred for i in range(3)] == ["en", "de", "en"]


def test_language_without_training_rows(spark):
    filters = lid.learn(empty(spark))
    got = as_dict(lid.identify(docs(spark, ["hello", None]), filters))
    assert {r.lang_pred for r in got.values()} == {"und"}
    assert lid.identify(empty(spark), filters).count() == 0


def test_held_out_rows_are_not_learned_from(spark):
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    df = docs(spark, ["zqzq xkxk"] * 300, lang="zz")
    df = df.where(held_out(df["doc_id"]))
    assert df.count() == len(held) and lid.learn(df).languages == []


def test_slices_start_every_gram_once(monkeypatch):
    text = "abc " * 40 + "y" * 90 + "é漢 zz"
    whole = [np.sort(lid.gram_hashes(g)[1]) for g in lid.slices([text])]
    monkeypatch.setattr(lid, "SLICE_CHARS", 7)
    parts = np.sort(np.concatenate([lid.gram_hashes(g)[1] for g in lid.slices([text])]))
    assert len(whole) == 1 and (whole[0] == parts).all()


def test_bloom_masks_hold_every_language():
    grams = {f"l{j:03d}": np.arange(j * 7, j * 7 + 50, dtype=np.uint64) * np.uint64(2654435761)
             for j in range(130)}
    f = lid.Filters(sorted(grams), grams)
    hits, total = f.counts(np.zeros(50, dtype=int), grams["l100"], 1)
    assert f.words == 3 and hits[0, 100] == total[0] == 50 and np.median(hits[0]) < 10


def labelled(spark):
    from pyspark.sql import types as T
    clean = ["the quick brown fox saw the lazy dog near the bridge"] * 60
    toxic = ["the quick brown fox said you awful fool near the bridge"] * 60
    df = docs(spark, clean).unionAll(docs(spark, toxic, first=1000))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                           T.StructField("toxic", T.IntegerType())])
    rows = [(i, 1, 0) for i in range(60)] + [(1000 + i, 1, 1) for i in range(60)]
    return df, spark.createDataFrame(rows + rows[:3] + [(None, 1, 1), (5000, 1, None)], schema)


def test_toxicity_edge_cases(spark):
    df, labels = labelled(spark)
    scorer = tox.learn(df, labels)
    texts = odd_texts() + ["you awful fool", "the quick dog", "calm words here " * 20_000]
    got = as_dict(tox.classify(docs(spark, texts, extra={"predicted": "x", "toxic": 1}), scorer))
    n = len(odd_texts())
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and math.isfinite(r.score) for r in got.values())
    assert all(got[i].predicted == 0 for i in range(4))
    assert got[n].score > 0.5 > got[n + 1].score and got[n + 2].predicted == 0


def test_toxicity_without_labels(spark):
    df, labels = labelled(spark)
    for own in (labels.limit(0), labels.where("toxic = 0")):
        got = tox.classify(df, tox.learn(df, own)).collect()
        assert len(got) == 120 and {r.score for r in got} == {0.0}
    assert tox.classify(empty(spark), tox.learn(empty(spark), labels)).count() == 0
