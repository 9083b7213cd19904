"""Token alignment against brute force over all pairs of ends."""

import hashlib
import random

import numpy as np
import pytest
from edge import DOCS, PLAIN, docs, empty, odd_texts

from fraudlens.llm import bpe
from fraudlens.llm import op12_token_alignment as al

A, B = bpe.default_path(), bpe.default_path("piece_bpe_32k.model")


def brute(texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by the libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer
    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    ta.no_truncation()
    to_byte = {c: b for b, c in enumerate(bpe.byte_alphabet())}
    rows, counts = [], {}
    for text in texts:
        raw, links, groups = (" " + (text or "")).encode(), [], []
        a = ta.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        bytes_a = [bytes(to_byte[c] for c in ta.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i)
                   else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            rows.append((0, 0, [], []))
            continue
        ends_a = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in bytes_a]))}
        ends_b = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in bytes_b]))}
        i = j = 0
        for end in sorted(set(ends_a) & set(ends_b)):
            links.append((a[ends_a[end]], b[ends_b[end]]))
            groups.append(",".join(map(str, a[i:ends_a[end] + 1])) + "|" + ",".join(map(str, b[j:ends_b[end] + 1])))
            i, j = ends_a[end] + 1, ends_b[end] + 1
        for link in links:
            counts[link] = counts.get(link, 0) + 1
        rows.append((len(a), len(b), groups, links))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [(n_a, n_b, len(g), len(k), sum(counts[x] == top[x[1]] for x in k), sum(counts[x] for x in k), ";".join(g))
            for n_a, n_b, g, k in rows]


def test_segments_against_set_of_ends():
    rng = random.Random(1)
    for _ in range(400):
        total = rng.randint(1, 300)
        own = [sorted({total, *rng.sample(range(1, total + 1), rng.randint(0, total))}) for _ in range(2)]
        if rng.random() < .5:                                  # long equal stretches
            own[1] = sorted({total, *[e for e in own[0] if rng.random() < .97], *rng.sample(range(1, total + 1), 1)})
        cuts, at = [], (0, 0)
        for a0, a1, b0, b1, single in al.segments(*own):
            assert (a0, b0) == at and a1 > a0 and b1 > b0 and (not single or a1 - a0 == b1 - b0)
            assert not single or own[0][a0:a1] == own[1][b0:b1]
            cuts += own[0][a0:a1] if single else [own[0][a1 - 1]]
            at = a1, b1
        assert cuts == sorted(set(own[0]) & set(own[1])) and at == (len(own[0]), len(own[1]))


def texts_of(seed, n):
    rng = random.Random(seed)
    parts = ["the ", "naïve ", "Straße", "  ", "\n\n", "\t", "漢字", "🙂", "don't ", "1234 ", "x=y;", " fox", "quick", "\r\n",
             "<|endoftext|>", "<unk>", "<s>", " ", "é", "́", "_", "0x1F", "\x00", "ﬁ", "Ⅷ", "　", "<0x41>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("most", [1 << 19, 60, 0])
def test_corpus_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(al, "TASK_LINKS", 500)
    texts = odd_texts() + texts_of(2, 80) + [PLAIN, "a▁b", "▁"]
    df = docs(spark, texts, first=3, extra={"n_links": 5, "links": "x", "__row": 1}).repartition(6)
    monkeypatch.setattr(al.score_links, "__defaults__", (most,))            # fewer: counts come by the join
    got = {r.doc_id: r for r in al.align_corpus(df, outputs=tuple(al.OUTPUTS), keep=["doc_id"]).collect()}
    want = brute(texts)
    assert len(got) == len(texts) and any(r[0] == 0 for r in want[12:])
    for i, row in enumerate(want, 3):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == row, texts[i - 3][:80]
        assert r.groups_sha256 == (hashlib.sha256(row[-1].encode()).hexdigest() if row[0] else "")


def test_odd_tables(spark):
    assert al.align_corpus(empty(spark), keep=["doc_id"]).count() == 0
    rows = [(None, PLAIN, "", "", 0), (5, PLAIN, "", "", 0), (5, PLAIN, "", "", 0), (6, None, "", "", 0), (6, "", "", "", 0)]
    df = spark.createDataFrame(rows, DOCS)
    want = brute([r[1] for r in rows])
    got = al.align_corpus(df, outputs=("n_a", "n_b", "n_groups", "groups"), keep=["doc_id"]).collect()
    assert sorted((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got) == sorted(want)
    full = al.align(df)
    assert full.columns == [*DOCS.names, *al.OUTPUTS] and full.count() == 5
