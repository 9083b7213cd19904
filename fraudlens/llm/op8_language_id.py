"""Language identification with bit-sliced Bloom filters of n-grams.

One table holds, for each of its slots, a bit mask of languages; a gram's
mask is the AND of the masks at its ``PROBES`` slots, so one look-up returns
every language whose filter contains the gram.  A text's grams are counted
per language by adding up those bits; the count of language l is corrected
for the filter's false positives, ``(hits - n * p) / (1 - p)`` with p the
filled share of l's slice to the power ``PROBES``, and the largest corrected
count decides (ties: the language with more learnable rows, then the smaller
name).  The score is that count's
share of all grams.

A gram starts at any letter of the lower-cased text: the character before it
(0 if no letter), the letter, and the two letters after it up to the end of
the word.  Learning reads at most about ``TRAIN_DOCS`` documents per language
(a hash sample of the rows that may be learned from) and keeps each
language's ``GRAMS_PER_LANG`` most frequent grams; that bounds the table.  A
gram that is ``1 / MIN_SHARE`` times as frequent in another language counts as
stray (quotations, wrong labels) and is left out.
Prediction reads every text whole, in slices of ``SLICE_CHARS`` characters,
without any shuffle.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
with no labelled rows everything is ``und``; a text in a language that was
not learned gets the nearest language with a low score; a null id is learned
from like the empty id; repeated rows give repeated results; an empty table
gives an empty result; an input column named like an output is replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.bpe import Cache
from fraudlens.llm.common import arrow_map, held_out, map_text, parts_of, table

TRAIN_DOCS = 2_000
GRAMS_PER_LANG = 60_000
MIN_SHARE = 0.05        # of the gram's rate in the language that has it most
PROBES = 3
SLICE_CHARS = 500_000
OUTPUTS = "lang_pred string, score double"
UNKNOWN = "und"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5],
                dtype=np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def slices(texts):
    """(indices, texts) groups of about SLICE_CHARS characters.  A long text
    is cut at its last space before the limit, or with an overlap that makes
    every gram start exactly once where there is none."""
    group, size = [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        at = 0
        while True:
            end = len(text)
            if end - at > SLICE_CHARS:
                end = text.rfind(" ", at, at + SLICE_CHARS) + 1 or at + SLICE_CHARS
                end = end if end > at else at + SLICE_CHARS
            # one character before and two after complete the outer grams
            group.append((i, text[max(0, at - 1):at] or " ", text[at:end], text[end:end + 2]))
            size += end - at
            if size >= SLICE_CHARS:
                yield group
                group, size = [], 0
            at = end
            if at >= len(text):
                break
    if group:
        yield group


def gram_hashes(group):
    """(owner, hash) arrays of all grams that start in the parts of a group."""
    parts, owners, counted = [], [], []
    for i, before, body, after in group:
        parts.append(before + body + after.ljust(2))
        counted.append(len(body))
        owners.append(i)
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    sizes = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    inside = np.zeros(len(codes) + 1, dtype=np.int8)
    np.add.at(inside, starts + 1, 1)
    np.add.at(inside, starts + 1 + np.array(counted), -1)
    at = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & (codes > 0))
    first, second = codes[at + 1], codes[at + 2]
    h = codes[at - 1] * _MIX[0] + codes[at] * _MIX[1] + first * _MIX[2]
    h += np.where(first > 0, second, 0) * _MIX[3]
    h ^= h >> np.uint64(29)
    h *= _MIX[0]
    h ^= h >> np.uint64(32)
    owner = np.repeat(np.array(owners), sizes)[at]
    return owner, h


class Filters:
    """The bit-sliced table; ``words`` masks of 64 languages side by side."""

    def __init__(self, languages: list[str], grams: dict[str, np.ndarray]):
        self.languages = languages
        self.words = max(1, -(-len(languages) // 64))
        most = max([len(g) for g in grams.values()], default=1)
        bits = max(10, int(np.ceil(np.log2(most * 8))))      # slices at most about a third full
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = np.zeros((self.words, 1 << bits), dtype=np.uint64)
        self.false_positive = np.zeros(len(languages))
        for j, lang in enumerate(languages):
            w, bit = divmod(j, 64)
            for slot in self.probes(grams[lang]):
                self.slots[w, slot] |= np.uint64(1 << bit)
            filled = ((self.slots[w] >> np.uint64(bit)) & np.uint64(1)).mean()
            self.false_positive[j] = filled ** PROBES

    def probes(self, h: np.ndarray):
        step = (h >> np.uint64(32)) | np.uint64(1)
        return [((h + np.uint64(k) * step) & self.mask).astype(np.int64) for k in range(PROBES)]

    def counts(self, owner: np.ndarray, h: np.ndarray, n: int):
        """(n, languages) hits and (n,) grams."""
        total = np.bincount(owner, minlength=n)
        hits = np.zeros((n, len(self.languages)))
        slots = self.probes(h)
        for w in range(self.words):
            found = self.slots[w][slots[0]]
            for s in slots[1:]:
                found &= self.slots[w][s]
            for j in range(w * 64, min(len(self.languages), w * 64 + 64)):
                has = (found >> np.uint64(j % 64)) & np.uint64(1)
                hits[:, j] = np.bincount(owner, weights=has, minlength=n)
        return hits, total

    def decide(self, texts):
        Cache.release()
        n = len(texts)
        hits, total = np.zeros((n, len(self.languages))), np.zeros(n)
        for group in slices(texts):
            owner, h = gram_hashes(group)
            if len(h):
                a, b = self.counts(owner, h, n)
                hits += a
                total += b
        names, scores = [UNKNOWN] * n, [0.0] * n
        if not self.languages:
            return names, scores
        p = self.false_positive
        share = np.clip((hits - total[:, None] * p) / (1 - p) / np.maximum(total, 1)[:, None], 0, 1)
        best = share.argmax(axis=1)                        # ties: the first language
        for i in np.flatnonzero(total):
            names[i], scores[i] = self.languages[best[i]], float(share[i, best[i]])
        return names, scores


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS) -> Filters:
    """Filters from the rows that are not held out and have a language."""
    rows = docs.where(~held_out(docs[id_col]) & docs[lang_col].isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}     # one row per language
    if not sizes:
        return Filters([], {})
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(docs[lang_col] == lang, F.lit(min(1.0, train_docs / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(docs[id_col]), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(draw < share).select(docs[lang_col].alias("lang"), docs[text_col].alias("text"))

    def count(batches):
        for batch in parts_of(batches):
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            names, code = np.unique(langs.astype(str), return_inverse=True)
            for group in slices(batch.column(1).to_pylist()):
                owner, h = gram_hashes(group)
                for k, name in enumerate(names):
                    grams, n = np.unique(h[code[owner] == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                         pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counts = (arrow_map(sample, count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    grams = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    rates = counts.join(F.broadcast(grams), "lang").withColumn("rate", F.col("n") / F.col("all"))
    own = rates.withColumn("most", F.max("rate").over(Window.partitionBy("gram"))).where(
        F.col("rate") >= MIN_SHARE * F.col("most"))
    best = own.withColumn("place", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= GRAMS_PER_LANG)
    found = best.select("lang", "gram").toPandas()          # <= GRAMS_PER_LANG per language
    languages = sorted(found["lang"].unique(), key=lambda x: (-sizes[x], x))
    return Filters(languages, {x: found.loc[found["lang"] == x, "gram"].to_numpy().view(np.uint64)
                               for x in languages})


def identify(docs: DataFrame, filters: Filters, text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    return map_text(docs, lambda texts: shared.value.decide(texts), OUTPUTS, text_col, keep)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
