"""Spelling variants by a bit-sliced position index.

A word's index entry is one bit in every bitset (position, letter) it holds;
a query reads its own letters from left to right and keeps, for all indexed
words at once, the set of words without an error so far and the sets with one
error: one letter replaced (same position), one extra in the word (position
shifted by one to the right) or one missing (to the left).  Each step is a few
operations on whole bitsets (Python integers), so one machine word serves 64
vocabulary words.  Bits are given in the order (count descending, word), so the lowest
bit of the answer is the word's form and its population the number of near words.

Distribution: one index over the vocabulary would be one task's.  A pair of
near words has lengths L, L or L, L + 1; the shorter word's positions are cut
into three segments, the error lies in one of them, and the letters outside it
are the same in both.  So a word is sent once per length class and segment,
keyed by the letters outside, and every key has its own index over the letters
inside.  A pair is counted in the one segment that holds its first differing
position, so nothing is counted twice and no pair is ever written.

Skew: counts are pre-aggregated per task.  A key of more than ``GROUP_WORDS``
words is cut again (its segment into three, as often as needed), until
the segment is one letter: then at most |alphabet| + |alphabet|^2, some 8,200,
different words are left.

Defined cases: null and empty texts have no words; a null id counts as the
empty text in front of the colon; repeated rows count repeatedly; runs of any
length are words; ties between forms go to the smaller word in code-point
order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.bpe import Cache
from fraudlens.llm.common import arrow_map, parts_of, staged, table

MIN_LETTERS, MIN_COUNT = 7, 2
TYPO_MOD = 31                # one (document, run) in so many loses a letter
FORM_RATIO = 10              # a form is at least so many times as frequent
SEGMENTS = 3
GROUP_WORDS = 4_096          # a larger key is cut again
TASK_WORDS = 400_000         # words that a task counts before it sends them on
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


# -- vocabulary ---------------------------------------------------------------
def runs_of(doc_id, text: str | None) -> dict[str, int]:
    """Words of one document with their counts, after the deletion rule.
    Every occurrence of a run in a document has the same fate."""
    found: dict[str, int] = {}
    if not text:
        return found
    for run in _RUN.findall(text.encode("utf-8").lower().decode("utf-8")):     # bytes: A-Z only
        found[run] = found.get(run, 0) + 1
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: dict[str, int] = {}
    for run, n in found.items():
        h = zlib.crc32(run.encode("utf-8"), head)
        if h % TYPO_MOD == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_LETTERS:
                continue
        out[run] = out.get(run, 0) + n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``MIN_LETTERS`` letters that occur at
    least ``MIN_COUNT`` times in all texts."""
    def count(batches):
        Cache.release()
        seen: dict[str, int] = {}

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                               pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in parts_of(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in runs_of(doc, text.as_py()).items():
                    seen[word] = seen.get(word, 0) + n
                if len(seen) >= TASK_WORDS:
                    yield sent()
                    seen = {}
        yield sent()

    rows = arrow_map(docs.select(docs[id_col].cast("string").alias("doc"), docs[text_col].alias("text")),
                     count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# -- the index ----------------------------------------------------------------
class PositionIndex:
    """Bitsets (position, letter) -> words, over the given distinct words;
    bit k stands for ``words[k]``."""

    def __init__(self, words: list[str]):
        self.at: dict[tuple[int, str], int] = {}
        self.length: dict[int, int] = {}         # words of exactly that length
        self.all = (1 << len(words)) - 1
        at = self.at
        for k, word in enumerate(words):
            bit = 1 << k
            self.length[len(word)] = self.length.get(len(word), 0) | bit
            for place in enumerate(word):
                at[place] = at.get(place, 0) | bit

    def near(self, word: str) -> tuple[int, int, int, int]:
        """(replaced, extra, missing, starts): the words that differ from
        ``word`` by one replaced letter, hold one letter more, or one less, and
        of the latter two those where the letter in question is the last."""
        at, m = self.at.get, len(word)
        same, other, longer, shorter, before = self.all, 0, 0, 0, 0
        for i, letter in enumerate(word):
            hits = at((i, letter), 0)
            # shorter: the letter is left out here, or was and the rest moved up
            shorter = (shorter & at((i - 1, letter), 0)) | same
            longer = (longer | same) & at((i + 1, letter), 0)
            before = same
            other = (other & hits) | (same & ~hits)
            same &= hits
        length = self.length.get
        more, less = length(m + 1, 0), length(m - 1, 0)
        return other & length(m, 0), (longer | same) & more, shorter & less, same & more | before & less


def near_in_group(words: list[tuple[str, int]], short: int, a: int, b: int):
    """(word, k, form, form_n) of the words of one key that have near words in
    its segment [a, b) of the length class ``short``: their number and the one
    with the largest count.  ``words`` are distinct."""
    if len(words) < 2:
        return []
    words.sort(key=lambda w: (-w[1], w[0]))
    tail = short - b
    inner = [w[a:len(w) - tail] for w, _ in words]
    index, out, last = PositionIndex(inner), [], b == short
    for (word, _), mid in zip(words, inner):
        replaced, extra, missing, ends = index.near(mid)
        if len(word) == short:
            found = replaced | (extra if last else extra & ~ends)
        else:
            found = missing if last else missing & ~ends
        if found:
            form, n = words[(found & -found).bit_length() - 1]
            out.append((word, found.bit_count(), form, n))
    return out


# -- keys ---------------------------------------------------------------------
def _cut(words: DataFrame, short: str, low: str, high: str) -> DataFrame:
    """Rows (word, n, short, a, b) with [a, b) one of three parts of [low, high)."""
    step = f"transform(sequence(0, {SEGMENTS - 1}), s -> named_struct(" \
           f"'a', cast({low} + ({high} - {low}) * s div {SEGMENTS} as int), " \
           f"'b', cast({low} + ({high} - {low}) * (s + 1) div {SEGMENTS} as int)))"
    cut = F.explode(F.filter(F.expr(step), lambda s: s["a"] < s["b"]))
    return (words.select("word", "n", F.expr(short).alias("short"), cut.alias("s"))
            .select("word", "n", "short", "s.a", "s.b"))


def _keyed(rows: DataFrame) -> DataFrame:
    """With the hash of the class, the segment and the letters outside it."""
    outside = [F.expr("substring(word, 1, a)"),
               F.expr("substring(word, b + 1 + char_length(word) - short)")]
    return rows.withColumn("key", F.xxhash64("short", "a", "b", *outside))


def _groups(vocabulary: DataFrame):
    """Tables of keyed rows whose keys hold a bounded number of words."""
    classes = vocabulary.select("word", "n", F.explode(F.expr(
        f"filter(array(char_length(word), char_length(word) - 1), l -> l >= {MIN_LETTERS})")).alias("short"))
    rows = staged(_keyed(_cut(classes, "short", "0", "short")), "keyed")
    while True:
        hot = rows.where("b - a > 1").groupBy("key").agg(F.count("*").alias("c")).where(
            F.col("c") > GROUP_WORDS).select("key")
        hot = staged(hot, "hot-keys")
        if hot.isEmpty():
            yield rows
            return
        yield rows.join(hot, "key", "left_anti")
        again = rows.where("b - a > 1").join(hot, "key", "left_semi")
        rows = staged(_keyed(_cut(again, "short", "a", "b")), "keyed")


def _compared(rows: DataFrame) -> DataFrame:
    """(word, k, form, form_n) per word and key that has near words in it."""
    def compare(batches):
        Cache.release()
        key, groups, out = None, {}, []

        def done():
            for (short, a, b, *_), words in groups.items():
                out.extend(near_in_group(words, short, a, b))

        def sent():
            columns = list(zip(*out)) or [(), (), (), ()]
            types = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["word", "k", "form", "form_n"])

        for batch in batches:
            for k, word, n, short, a, b in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if k != key:
                    done()
                    key, groups = k, {}
                # Equal hashes are told apart by the letters themselves.
                own = (short, a, b, word[:a], word[len(word) - short + b:])
                groups.setdefault(own, []).append((word, n))
            yield sent()
            out = []
        done()
        yield sent()

    dealt = (rows.select("key", "word", "n", "short", "a", "b")
             .repartition("key").sortWithinPartitions("key"))
    return arrow_map(dealt, compare, "word string, k long, form string, form_n long")


# -- groups -------------------------------------------------------------------
def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of every chain word -> form.  A chain's counts
    grow by ``FORM_RATIO`` a step, so few doublings reach all ends."""
    found = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(found.join(onward, "root", "left"), "roots")
        if moved.where("next is not null").isEmpty():
            return found
        found = moved.select("word", F.coalesce("next", "root").alias("root"))


def variant_groups(vocabulary: DataFrame) -> DataFrame:
    """``vocabulary`` (word, n; distinct words) with n_near, form, form_n and
    root."""
    vocabulary = staged(vocabulary.select("word", "n"), "vocabulary")
    rows = vocabulary.select("word", "n", F.lit(0).cast("long").alias("k"),
                             F.lit(None).cast("string").alias("form"), F.lit(None).cast("long").alias("form_n"))
    for group in _groups(vocabulary):
        found = _compared(group)
        rows = rows.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), "form")))
    near = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("k").alias("n_near"), best.alias("best"))
    enough = -F.col("best.m") >= FORM_RATIO * F.col("n")
    near = staged(near.select("word", "n", "n_near", F.when(enough, F.col("best.form")).alias("form"),
                              F.when(enough, -F.col("best.m")).alias("form_n")), "near")
    ends = roots(near.where("form is not null"))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(spark, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents"))
    return variant_groups(words).select("word", "n", "n_near", "form", "form_n", "root")
