"""The bit-plane store: exact round trips."""

import random
import zlib

import numpy as np
import pytest
from edge import DOCS, PLAIN, docs, empty, odd_texts

from fraudlens.llm import bpe
from fraudlens.llm import op9_bitplane_store as store


@pytest.mark.parametrize("unit", [1, 8])
def test_blocks_round_trip(unit):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 1_000):
        for top in (1, 2, 300, 50_257, 1 << 32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
            data, lengths = store.pack(ids, unit)
            assert sum(lengths) == len(data) and (store.unpack(data, lengths, n, unit) == ids).all()
    assert store.pack(np.zeros(50, "<u4"))[1] == []


def test_crc_join():
    rng = random.Random(2)
    for _ in range(100):
        a, b = (rng.randbytes(rng.choice([0, 1, 5, 300, 70_000])) for _ in range(2))
        assert store.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("block_ids,unit", [(1 << 18, 1), (64, 1), (50, 8)])
def test_documents_round_trip(spark, scratch, block_ids, unit):
    texts = odd_texts() + [PLAIN * k for k in range(1, 40)] if block_ids > 64 else [
        t for t in odd_texts() if t is None or len(t) < 5_000] + [PLAIN * k for k in range(1, 40)]
    random.Random(3).shuffle(texts)
    path = scratch("planes")
    store.write_tokens(docs(spark, texts, first=10, extra={"shard": 1, "doc": "x"}).repartition(5), path,
                       unit=unit, block_ids=block_ids)
    library, start = bpe.Encoder(bpe.default_path()).tokenizer, 0
    got = {r.doc: r for r in store.read_index(spark, path, unit, ids=True).collect()}
    same = {r.doc: r for r in store.read_index(spark, path, unit).collect()}
    assert len(got) == len(same) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        r = got[10 + i]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (same[10 + i].start, same[10 + i].ids_crc32) == (r.start, r.ids_crc32)
        start += len(ids)


def test_odd_tables(spark, scratch):
    path = scratch("planes")
    store.write_tokens(empty(spark), path)
    assert store.read_index(spark, path).count() == 0
    path = scratch("planes")
    rows = [(None, "a", "", "", 0), (5, "b", "", "", 0), (5, None, "", "", 0), (5, "b", "", "", 0), (2, "", "", "", 0)]
    store.write_tokens(spark.createDataFrame(rows, DOCS), path)
    got = sorted(store.read_index(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc, r.n_tokens) for r in got] == [(None, 2), (2, 1), (5, 1), (5, 2), (5, 2)]
    assert [r.start for r in got] == [0, 2, 3, 4, 6]
