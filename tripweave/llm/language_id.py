"""Language identification (operator 2): multinomial naive Bayes over hashed
character n-grams.

Training counts the n-grams (1 to 3 lower-case characters, hashed to ``BUCKETS``
buckets) of all labelled texts.  Tasks send one row per language and bucket they
met, so the shuffle is bounded by tasks x languages x buckets.  The matrix of
log probabilities, languages x buckets, is bounded by ``MAX_LANGUAGES`` (more is
an error) and broadcast; texts are scored in sparse batches, one gather and
segment sum per language.

Rows: a null text or one without a letter is ``und`` with score 0, and so is
every text when nothing was learned; ties go to the language that sorts first; a
null label teaches nothing; a null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tripweave.llm.common import prepare, record_batch, released, text_slices

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 500
LETTER = regex.compile(r"\p{L}")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of ``texts``, text by text, and where each text starts."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(p) for p in padded], np.int64)
    # one hash per place and order; those that would cross into the next text are dropped
    place_in = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - place_in
    parts, owner = [], []
    doc = np.repeat(np.arange(len(texts)), sizes)
    for n in ORDERS:
        h = np.full(max(len(codes) - n + 1, 0), n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k:len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        ok = left[:len(h)] >= n
        parts.append((h[ok] & np.uint64(BUCKETS - 1)).astype(np.int32))
        owner.append(doc[:len(h)][ok])
    return np.concatenate(parts), np.concatenate(owner)


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of (text, lang)."""
    prepare(labelled.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for langs, texts in text_slices(batches, ("lang",)):
            for lang in set(langs) - {None}:
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang and t]
                if own:
                    buckets, _ = grams(own)
                    total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(buckets, minlength=BUCKETS)
        for lang, total in totals.items():
            met = np.flatnonzero(total)
            yield record_batch({"lang": [lang] * len(met), "bucket": met, "n": total[met]}, schema)

    parts = (labelled.select("text", "lang").filter("text is not null and lang is not null")
             .mapInArrow(released(run), "lang string, bucket int, n long"))
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in ascending order and their log probabilities."""

    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        best, score = ["und"] * len(texts), [0.0] * len(texts)
        if not known or not self.languages:
            return best, score
        buckets, owner = grams([texts[i] for i in known])
        total = np.stack([np.bincount(owner, weights=row[buckets], minlength=len(known)) for row in self.log_p])
        top = total.argmax(axis=0)
        odds = np.exp(total - total.max(axis=0))
        sure = odds.max(axis=0) / odds.sum(axis=0)
        for at, k, s in zip(known, top, sure, strict=True):
            best[at], score[at] = self.languages[k], float(s)
        return best, score


def train(labelled: DataFrame, smoothing: float = 0.5) -> Model:
    """Fit on all rows of (text, lang)."""
    counts = count_grams(labelled)
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(languages), BUCKETS), smoothing)
    # at most MAX_LANGUAGES x BUCKETS numbers, a language a row
    rows = counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    for r in rows.toLocalIterator():
        table[languages.index(r["lang"]), np.array(r["b"])] += np.array(r["n"])
    return Model(languages, (np.log(table) - np.log(table.sum(axis=1, keepdims=True))).astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, from the text alone."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast((model.languages, model.log_p))
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = StructType([*docs.select(*others).schema, StructField("lang_pred", StringType()),
                      StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            langs, scores = [], []
            for (texts,) in text_slices([batch], ()):
                a, b = own.predict(texts)
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return docs.select(*others).mapInArrow(released(run), out)
