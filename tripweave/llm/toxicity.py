"""Toxicity by multiple-instance learning (operator 9).

A document is a bag of sentences.  Each sentence has a probability from a
logistic model over its distinct lower-case words and their beginnings (hashed);
the document's is their noisy-or, 1 - prod(1 - p).  Only documents are labelled:
gradients of the document's likelihood pass through the noisy-or to the
sentences, which so learn which of them the label came from.  The trained
sentence scores then locate the offending sentences.

Training has two passes.  The first counts, over all labelled texts, in how many
documents of each label a feature occurs; only features whose share of toxic
documents differs significantly from the common share are kept, so a rare word
is not learnt by heart.  The second fits weights to the bags of at most
``max_docs`` labelled documents that have a word and at most ``max_chars``
characters (the lowest hashes of doc_id, both are parameters): half of them of
each label, or more of one if the other has fewer; only kept features come to
the driver.  A bag weighs as much as its label's counted documents for
each one taken, so the loss is that of the counted shares.  If no bag of one
label can be taken, the weights are the counted log odds.  Scoring goes over all
texts.

Rows: null, empty and word-less texts are bags with no sentence and score 0; a
label that is null, or whose document is missing, teaches nothing; a null doc_id
is not held out; without labels of both kinds, or a feature that tells them
apart, every score is 0; repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from tripweave.llm.common import prepare, record_batch, released, text_slices, written

BUCKETS = 1 << 18
SENTENCE = re.compile(r"[^.!?\n]+")
TOKEN = re.compile(r"[^\W\d_]+")
#: A character of a TOKEN, as Spark's patterns have it.
TOKEN_CHAR = r"[\p{L}\p{Nl}\p{No}]"
#: Bias of a sentence before the fit.
BIAS = -6.0


class Features(dict):
    """Buckets of a word: the word itself and its beginnings of 3 to 7 letters."""

    def __missing__(self, word: str) -> array:
        if len(self) >= 100_000:   # bounds the memory only, to about 20 MB
            self.clear()
        keys = [word, *("^" + word[:n] for n in range(3, 8) if len(word) > n)]
        self[word] = got = array("i", [xxhash.xxh3_64_intdigest(k.encode("utf-8", "surrogatepass")) % BUCKETS for k in keys])
        return got


_FEATURES = Features()


def _released(run: Callable) -> Callable:
    """``run`` with this module's word cache emptied when its task ends; looked up
    there, so the cache is never part of the function that Spark ships."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from released(run, _FEATURES)(batches)

    return task


def sentences(text: str | None) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct words) of each sentence that has a word."""
    for m in SENTENCE.finditer(text or ""):
        words = TOKEN.findall(m[0].lower())
        if words:
            yield m.start(), m.end(), set(words)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


class Model:
    """Weights of the kept features and the bias of a sentence."""

    def __init__(self, weights: dict[int, float], bias: float, trained: bool = True):
        self.weights, self.bias, self.trained = weights, bias, trained
        self.words: dict[str, float] = {}

    def _word(self, word: str) -> float:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= 200_000:   # bounds the memory only
                self.words.clear()
            got = self.words[word] = sum(self.weights.get(f, 0.0) for f in _FEATURES[word])
        return got

    def sentences(self, text: str | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Probability and span of each sentence of a whole text."""
        if not self.trained:
            return np.zeros(0), []
        known, word = self.words, self._word
        z, spans = [], []
        for start, end, words in sentences(text):
            spans.append((start, end))
            z.append(sum([known[w] if w in known else word(w) for w in words]))
        return _sigmoid(np.array(z, np.float64) + self.bias), spans

    def score(self, text: str | None) -> float:
        return noisy_or(self.sentences(text)[0])


def significant(counts: list[tuple[int, int, int]], toxic: int, clean: int,
                min_docs: int = 5, deviation: float = 4.0) -> dict[int, float]:
    """Feature -> half its log odds, of (feature, toxic documents, documents)
    whose toxic share lies ``deviation`` standard deviations from the common one."""
    if not toxic or not clean or not counts:
        return {}
    f, pos, n = (np.array(x, np.float64) for x in zip(*counts, strict=True))
    share = toxic / (toxic + clean)
    z = (pos / n - share) / np.sqrt(share * (1 - share) / n)
    odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((n - pos + 0.5) / (clean + 1))
    keep = (n >= min_docs) & (np.abs(z) > deviation)
    return {int(a): max(float(b), 0.0) / 2 for a, b in zip(f[keep], odds[keep], strict=True)}


def fit(bags: list[tuple[np.ndarray, np.ndarray, int, int]], start: dict[int, float], toxic: int | None = None,
        clean: int | None = None, epochs: int = 200, rate: float = 0.1, shrink: float = 1e-5) -> Model:
    """Bags of (feature, its sentence, sentences, label), taken of ``toxic`` and
    ``clean`` documents (default: these are all).  Adam steps: their
    size does not depend on how many features a sentence has, so the descent is
    as steady for large training sets; the weights of the least loss are kept."""
    if not start:
        return Model({}, 0.0, trained=False)
    bags = [b for b in bags if b[2]]
    labels = np.array([y for *_, y in bags], np.float64)
    taken = labels.sum(), len(labels) - labels.sum()
    if not all(taken):
        return Model(start, BIAS)
    of = (taken[0] if toxic is None else toxic, taken[1] if clean is None else clean)
    share = np.where(labels > 0, of[0] / sum(of) / taken[0], of[1] / sum(of) / taken[1])   # sums to 1
    sizes = np.array([n for _, _, n, _ in bags])
    base = np.cumsum(sizes) - sizes
    known = np.array(sorted(start))
    feature = np.searchsorted(known, np.concatenate([b[0] for b in bags]))
    sentence = np.concatenate([b[1] + o for b, o in zip(bags, base, strict=True)])
    doc = np.repeat(np.arange(len(bags)), sizes)
    theta = np.append([start[int(k)] for k in known], BIAS)
    best, least = theta, np.inf
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, epochs + 1):
        p = _sigmoid(np.bincount(sentence, theta[feature], len(doc)) + theta[-1])
        clear = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags))   # log of no offence
        bag = np.clip(-np.expm1(clear), 1e-9, 1 - 1e-9)
        loss = -(share * np.where(labels > 0, np.log(bag), clear)).sum() + shrink / 2 * (theta[:-1] ** 2).sum()
        if loss < least:
            best, least = theta, loss
        # slope of the loss in a sentence's logit: p in clean bags, -p (1 - bag) / bag in toxic ones
        slope = p * (share * np.where(labels > 0, -(1 - bag) / bag, 1.0))[doc]
        grad = np.append(np.bincount(feature, slope[sentence], len(known)), slope.sum())
        grad[:-1] += shrink * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta = theta - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Model({int(k): float(w) for k, w in zip(known, best[:-1], strict=True)}, float(best[-1]))


def _words(texts: DataFrame) -> DataFrame:
    """(doc_id, words): the distinct lower-case words of each text, compressed.
    They take a fraction of the text, and are all that the join with the labels
    has to shuffle."""
    out = StructType([texts.schema["doc_id"], StructField("words", BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [zlib.compress(" ".join(sorted(set(TOKEN.findall(t.as_py().lower()))))
                                   .encode("utf-8", "surrogatepass"), 1) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.binary())],
                                             names=["doc_id", "words"])

    return texts.select("doc_id", "text").mapInArrow(_released(run), out)


def _count(labelled: DataFrame) -> tuple[list[tuple[int, int, int]], int, int]:
    """Documents per feature and label over all rows of (words, toxic): at most
    ``BUCKETS`` rows come back.  Bucket -1 counts the documents."""
    schema = pa.schema([("feature", pa.int32()), ("toxic", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for y, packed in zip(batch.column("toxic").to_pylist(), batch.column("words"), strict=True):
                words = zlib.decompress(packed.as_py()).decode("utf-8", "surrogatepass").split(" ")
                found = {f for w in words if w for f in _FEATURES[w]}
                if found:
                    at = np.fromiter(found, np.int64, len(found))
                    for row in totals[1 - (y > 0):]:    # row 0: toxic documents, row 1: all
                        row[at] += 1
                        row[BUCKETS] += 1
        met = np.flatnonzero(totals[1])
        yield record_batch({"feature": np.where(met == BUCKETS, -1, met), "toxic": totals[0][met],
                            "n": totals[1][met]}, schema)

    rows = (labelled.select(F.col("toxic").cast("int"), "words").mapInArrow(_released(run), "feature int, toxic long, n long")
            .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).collect())
    total = next(((r["toxic"], r["n"]) for r in rows if r["feature"] == -1), (0, 0))
    return [(r["feature"], r["toxic"], r["n"]) for r in rows if r["feature"] >= 0], total[0], total[1] - total[0]


def _bags(labelled: DataFrame, kept: set[int]) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
    sent = labelled.sparkSession.sparkContext.broadcast(kept)   # at most BUCKETS numbers
    schema = pa.schema([("toxic", pa.int32()), ("h", pa.int64()), ("n", pa.int32()),
                        ("feature", pa.binary()), ("sentence", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = sent.value
        for ys, hs, texts in text_slices(batches, ("toxic", "h")):
            rows = []
            for y, h, text in zip(ys, hs, texts, strict=True):
                found, where, n = [], [], 0
                for n, (_, _, words) in enumerate(sentences(text), 1):
                    own = [f for w in words for f in _FEATURES[w] if f in keep]
                    found += own
                    where += [n - 1] * len(own)
                rows.append((y, h, n, np.array(found, "<i4").tobytes(), np.array(where, "<i4").tobytes()))
            yield record_batch(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    rows = labelled.mapInArrow(_released(run), "toxic int, h long, n int, feature binary, sentence binary").collect()
    return [(np.frombuffer(r["feature"], "<i4"), np.frombuffer(r["sentence"], "<i4").astype(np.int64), r["n"],
             int(r["toxic"] > 0)) for r in sorted(rows)]


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 6000, max_chars: int = 1_000_000) -> Model:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic)."""
    prepare(docs.sparkSession)
    labels = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
    texts = docs.select("doc_id", "text").filter("text is not null")
    counts, toxic, clean = _count(_words(texts).join(labels, "doc_id"))
    start = significant(counts, toxic, clean)
    if not start:
        return fit([], start)
    usable = texts.filter(F.length("text") <= max_chars)
    # ids only: labels whose document can be a bag
    known = written(labels.withColumn("toxic", (F.col("toxic").cast("int") > 0).cast("int")).join(
        usable.filter(F.col("text").rlike(TOKEN_CHAR)).select("doc_id"), "doc_id", "left_semi")
        .withColumn("h", F.xxhash64("doc_id")), "labelled")
    have = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    half = max_docs // 2
    most = {1: max(half, max_docs - have.get(0, 0)), 0: max(max_docs - half, max_docs - have.get(1, 0))}
    lowest = [known.filter(F.col("toxic") == y).orderBy("h").limit(most[y]) for y in (1, 0)]
    bags = _bags(usable.join(F.broadcast(lowest[0].union(lowest[1])), "doc_id").select("toxic", "h", "text"), set(start))
    # a repeated doc_id has several bags
    return fit([b for y in (1, 0) for b in [b for b in bags if b[3] == y][:most[y]]], start, toxic, clean)


def score(docs: DataFrame, model: Model, located_at: float = 0.5) -> DataFrame:
    """``docs`` with toxicity and offending: (start, end, p) of every sentence
    whose own probability is ``located_at`` or more."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast((model.weights, model.bias, model.trained))
    others = [c for c in docs.columns if c not in ("toxicity", "offending")]
    out = StructType([*docs.select(*others).schema, StructField("toxicity", DoubleType()), StructField(
        "offending", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()),
                                           StructField("p", DoubleType())])))])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            scores, found = [], []
            for text in batch.column("text"):
                p, spans = own.sentences(text.as_py())
                scores.append(noisy_or(p))
                found.append([{"start": spans[i][0], "end": spans[i][1], "p": float(p[i])}
                              for i in np.flatnonzero(p >= located_at)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(found, span)],
                names=[*batch.schema.names, "toxicity", "offending"])

    return docs.select(*others).mapInArrow(_released(run), out)
