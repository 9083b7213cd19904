"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on
ordinary and toxic text; a window that compresses shorter with the second one
resembles what only toxic documents hold.  A window is one lower-cased word
between markers that no text contains, behind an anchor that both
dictionaries know (it keeps tiny inputs out of the uncompressed block form,
so that lengths compare byte by byte).

Labels mark whole documents, and most of a toxic document is ordinary text.
So the toxic text to train on is first narrowed: the words of toxic documents
that begin with a segment (a whole word or its first ``SEGMENT`` characters)
which is in toxic documents significantly more often than in ordinary ones
(z test).  Calibration: for every pair (length with the ordinary dictionary,
length with the toxic one) the log ratio of toxic to ordinary documents that
have a window with that pair; and over the strongest ratio, and the counts
and shares of windows beyond ``THRESHOLDS``, a logistic regression that gives
the score.

Learning reads a hash sample of at most about ``TRAIN_DOCS`` labelled rows per
class, never a held-out row; the label sample is broadcast to the documents,
which are not shuffled.  Scoring reads every text whole, in its partition,
with a bounded cache of word lengths in the worker.

Defined cases: null, empty and letterless texts have no windows and get the
low score of a document without marks; without rows of both labels every
score is 0; a document with several labels counts as toxic if one says so;
unlabelled rows and null ids are scored but not learned from; repeated rows
give repeated results; an empty table gives an empty result; an input column
named like an output is replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.bpe import Cache
from fraudlens.llm.common import arrow_map, held_out, map_text, parts_of, staged, table

TRAIN_DOCS = 6_000
SEGMENT = range(4, 17)          # characters of a word start that may be a mark
MIN_DOCS, MIN_Z, MIN_RATIO = 5, 6.0, 5.0
MARKS, TOXIC_WORDS, ORDINARY_WORDS = 5_000, 800, 8_000
ORDINARY_BYTES, TOXIC_BYTES, ANCHOR_BYTES = 32 << 10, 4 << 10, 96
THRESHOLDS = (1.0, 2.0, 3.0)
LIMIT = 0.7
OUTPUTS = "score double, predicted int"
_WORD = re.compile(r"[^\W\d_]+")
_START, _END = b"\x01\x02\x03", b"\x04\x05"
_ANCHOR_END = b"\x07"            # keeps a match of the anchor from running into a window
_TAIL = bytes(range(0x0E, 0x18))  # zstandard starts no match in the last 8 bytes of its input
_SIDE = 32                       # lengths are clipped to 0.._SIDE-1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def segments_of(word: str):
    """The whole word (closed by a blank) and its longer starts."""
    yield word + " "
    for n in SEGMENT:
        if n > len(word):
            return
        yield word[:n]


def window(word: str) -> bytes:
    return _START + word.encode("utf-8") + _END


class Scorer:
    """The two compressors and the calibration; made on the driver from
    bounded counts, sent to the workers as plain values."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.anchor = ordinary[:ANCHOR_BYTES] + _ANCHOR_END
        self.contents = (ordinary + self.anchor, ordinary + toxic + self.anchor)
        self.ratio = np.zeros(_SIDE * _SIDE)
        self.weights: np.ndarray | None = None
        self._ready = None

    def __getstate__(self):
        return {**self.__dict__, "_ready": None}

    def _compressors(self):
        import zstandard
        for content in self.contents:
            params = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_BTOPT, min_match=3, window_log=17, hash_log=17, chain_log=17,
                search_log=4, target_length=32, write_content_size=False, write_checksum=False,
                write_dict_id=False)
            yield zstandard.ZstdCompressor(
                compression_params=params,
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    @property
    def cells(self) -> Cache:
        """word -> its pair of compressed lengths as one number."""
        if self._ready is None:
            ordinary, toxic = self._compressors()
            low = [len(c.compress(self.anchor + _START + _TAIL)) for c in (ordinary, toxic)]

            def cell(word: str) -> int:
                data = self.anchor + window(word) + _TAIL
                a, b = (min(_SIDE - 1, max(0, len(c.compress(data)) - at))
                        for c, at in zip((ordinary, toxic), low))
                return a * _SIDE + b
            self._ready = Cache(cell, entries=200_000)
        return self._ready

    def cells_of(self, text: str | None) -> np.ndarray:
        cells = self.cells
        found = np.array(list(map(cells.__getitem__, words_of(text))), dtype=np.int64)
        cells.trim()
        return found

    def features(self, cells: np.ndarray) -> np.ndarray:
        ratio = self.ratio[cells] if len(cells) else np.zeros(1)
        n = np.array([(ratio >= t).sum() for t in THRESHOLDS])
        return np.concatenate([[1.0, ratio.max()], np.log1p(n), np.sqrt(n / len(ratio)),
                               [np.log1p(len(ratio))]])

    def score(self, texts):
        if self.weights is None:
            return [0.0] * len(texts), [0] * len(texts)
        rows = np.array([self.features(self.cells_of(t)) for t in texts])
        scores = 1 / (1 + np.exp(-np.clip(rows @ self.weights, -40, 40)))
        return scores.tolist(), (scores >= LIMIT).astype(int).tolist()


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    train_docs: int) -> DataFrame:
    """(toxic, text) of at most about ``train_docs`` rows per class."""
    own = (labels.where(labels["toxic"].isNotNull() & labels[id_col].isNotNull() & ~held_out(labels[id_col]))
           .groupBy(F.col(id_col).alias("labelled")).agg(F.max("toxic").alias("toxic")))
    sizes = {r[0]: r[1] for r in own.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, train_docs / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    drawn = F.broadcast(own.where(draw < share))            # about 2 * train_docs rows of two numbers
    texts = docs.select(docs[id_col].alias("labelled"), docs[text_col].alias("text"))
    return texts.join(drawn, "labelled").select("toxic", "text")


def _counted(sample: DataFrame, fn, key: str) -> DataFrame:
    """(key, toxic, ordinary): documents of either class that have the key."""
    def count(batches):
        for batch in parts_of(batches):
            both = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                both[0 if toxic else 1].update(fn(text))
            keys = list(both[0] | both[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64() if key == "long" else pa.string()),
                 pa.array([both[0][k] for k in keys], pa.int64()),
                 pa.array([both[1][k] for k in keys], pa.int64())], names=["key", "toxic", "ordinary"])

    return (arrow_map(sample, count, f"key {key}, toxic long, ordinary long")
            .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          train_docs: int = TRAIN_DOCS) -> Scorer:
    sample = staged(labelled_sample(docs, labels, id_col, text_col, train_docs), "toxic-sample")
    n1, n0 = sample.agg(F.coalesce(F.sum((F.col("toxic") != 0).cast("long")), F.lit(0)),
                        F.coalesce(F.sum((F.col("toxic") == 0).cast("long")), F.lit(0))).first()
    if not n1 or not n0:
        return Scorer(b"", b"")

    # Marks: word starts that toxic documents have significantly more often.
    starts = _counted(sample, lambda t: {s for w in set(words_of(t)) for s in segments_of(w)}, "string")
    p1, p0 = F.col("toxic") / F.lit(n1), (F.col("ordinary") + 0.5) / F.lit(n0)
    pooled = (F.col("toxic") + F.col("ordinary")) / F.lit(n1 + n0)
    z = (p1 - p0) / F.sqrt(pooled * (1 - pooled) * F.lit(1 / n1 + 1 / n0) + F.lit(1e-12))
    marks = {r.key for r in starts.where(F.col("toxic") >= MIN_DOCS).withColumn("z", z)
             .where((F.col("z") > MIN_Z) & (p1 > MIN_RATIO * p0))
             .orderBy(F.desc("z"), "key").limit(MARKS).collect()}

    # Dictionary contents: the most frequent marked words of toxic documents
    # and unmarked words of ordinary ones, the most frequent last (nearest).
    counts = _counted(sample, lambda t: set(words_of(t)), "string")
    marked = F.lit(False)
    if marks:
        starts_of = [F.concat("key", F.lit(" "))] + [F.substring("key", 1, n) for n in SEGMENT]
        marked = F.arrays_overlap(F.array(*starts_of), F.lit(sorted(marks)))
    counts = staged(counts.withColumn("marked", marked), "toxic-words")

    def content(rows: DataFrame, by: str, n: int, size: int) -> bytes:
        best = rows.where(F.col(by) > 0).orderBy(F.desc(by), "key").limit(n).collect()
        return b"".join(window(r.key) for r in reversed(best))[-size:]

    scorer = Scorer(content(counts.where("not marked"), "ordinary", ORDINARY_WORDS, ORDINARY_BYTES),
                    content(counts.where("marked"), "toxic", TOXIC_WORDS, TOXIC_BYTES))

    # Calibration on the same sample, counted by Spark.
    shared = sample.sparkSession.sparkContext.broadcast(scorer)
    for r in _counted(sample, lambda t: set(shared.value.cells_of(t).tolist()), "long").collect():
        scorer.ratio[r.key] = (np.log((r.toxic + 1) / (n1 + 20)) - np.log((r.ordinary + 1) / (n0 + 20)))
    shared = sample.sparkSession.sparkContext.broadcast(scorer)
    found = map_text(sample, lambda ts: [[shared.value.features(shared.value.cells_of(t)).tolist() for t in ts]],
                     "row array<double>", keep=["toxic"]).toPandas()     # about 2 * train_docs short rows
    scorer.weights = _logistic(np.stack(found["row"].to_numpy()), (found["toxic"] != 0).to_numpy(float))
    return scorer


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Newton steps for a ridge-regularised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def classify(docs: DataFrame, scorer: Scorer, text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    return map_text(docs, lambda texts: shared.value.score(texts), OUTPUTS, text_col, keep)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = classify(docs, learn(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
