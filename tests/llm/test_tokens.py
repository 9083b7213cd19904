"""Token counts and the codec against the tokenizers library."""

import hashlib

import numpy as np
import pytest
from edge import PLAIN, as_dict, docs, empty, odd_texts

from fraudlens.llm import bpe, op1_token_counts, op3_bpe_codec


@pytest.fixture(scope="module")
def library():
    return bpe.Encoder(bpe.default_path()).tokenizer


def reference(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_library(spark, library):
    texts = odd_texts()
    got = as_dict(op1_token_counts.count_tokens(docs(spark, texts)))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n = len(reference(library, t))
        assert (got[i].n_tokens, got[i].n_bytes) == (n, len((t or "").encode()))
        assert got[i].over_limit == (n > op1_token_counts.LIMIT)


def test_counts_do_not_depend_on_the_table(spark, library, monkeypatch):
    monkeypatch.setattr(op1_token_counts, "length_table", lambda *a: (b"", b""))
    got = as_dict(op1_token_counts.count_tokens(docs(spark, [PLAIN, None])))
    assert got[0].n_tokens == len(reference(library, PLAIN)) and got[1].n_tokens == 0


def test_codec_equals_library(spark, library):
    texts = odd_texts()
    out = ("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")
    got = as_dict(op3_bpe_codec.encode_decode(docs(spark, texts), outputs=out, piece_chars=4_096))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = reference(library, t)
        assert got[i].ids == ids and got[i].n_tokens == len(ids), i
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(got[i].decoded.encode()).hexdigest()


def test_join_is_exact_on_hostile_stretches(library, monkeypatch):
    import random
    monkeypatch.setattr(bpe, "UNSPLIT_CHARS", 8)
    monkeypatch.setattr(bpe, "LEAF_CHARS", 4)
    enc, rng = bpe.Encoder(bpe.default_path()), random.Random(5)
    for _ in range(1_500):
        letters = rng.choice(["ab", "a", "aeiouthnr", "漢字仮名", "=-_*", "0123456789", " \n"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 150)))
        assert enc.encode(text) == b"".join(i.to_bytes(4, "little") for i in reference(library, text))


def test_pieces_behind_blank_lines_equal_library(spark, library):
    paragraphs = "\n\n".join(f"para {i}.  Some\t\twords <|endoftext|>\n\n \r\n\x1cit's" for i in range(4_000))
    texts = ["a\n\n" + "b" * 70_000, "a\n\n" * 20_000, paragraphs, "漢 \u3000\u3000字\n\n" * 9_000 + "x" * 66_000]
    want = [reference(library, t) for t in texts]
    enc = bpe.Encoder(bpe.default_path())
    for size in (7, 64, 500, 4_099):
        for text, ids in zip(texts, want):
            parts = op3_bpe_codec.token_pieces(enc, text, size)
            inside = [x for _, x in parts] + [False]
            alone = [inside[k] or inside[k + 1] for k in range(len(parts))]
            coded = [(op3_bpe_codec.encode_piece(enc, "".join(p), a, np.array([len(t) for t in p], "<u4").tobytes()),
                      a, x) for (p, x), a in zip(parts, alone)]
            assert np.frombuffer(op3_bpe_codec._group_parts(coded, enc), "<u4").tolist() == ids, size
    got = as_dict(op3_bpe_codec.encode_decode(docs(spark, texts), outputs=("ids",)))
    assert [got[i].ids for i in range(len(texts))] == want


def test_pieces_cover_the_text():
    enc = bpe.Encoder(bpe.default_path())
    for text in odd_texts():
        parts = op3_bpe_codec.pieces(enc, text or "", 100)
        assert "".join(p for p, _ in parts) == (text or "")


@pytest.mark.parametrize("run", [op1_token_counts.count_tokens, op3_bpe_codec.encode_decode])
def test_empty_table_and_clashing_columns(spark, run):
    assert run(empty(spark)).count() == 0
    got = run(docs(spark, ["a b", None], extra={"n_tokens": "x", "pretoken": 1})).collect()
    assert sorted(r.n_tokens for r in got) == [0, 2] and all(r.pretoken == 1 for r in got)


def test_repeated_rows_stay(spark):
    twice = docs(spark, ["a b", "long " * 20_000])
    twice = twice.unionAll(twice)
    assert op1_token_counts.count_tokens(twice).count() == 4
    assert op3_bpe_codec.encode_decode(twice, piece_chars=1_000).count() == 4
