"""The corpus pipeline: language ID, toxicity, near-duplicate join, packing.

Each stage takes the documents that its predecessor kept, written as Parquet and
read again, and works on all of them; its decisions take effect there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import best_fit, language_id, ngram_join, toxicity
from tripweave.llm.common import read_table, remainder, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no text, or no letter in it.  The
    model learns from the rows whose lang is known and not held out; if there are
    none, documents with a letter stay all the same."""
    model = language_id.train(docs.select("doc_id", "text", "lang").filter(
        ~F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))))
    return language_id.predict(docs.select(*COLUMNS), model).filter(
        (F.col("lang_pred") != "und") | F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score 0.7 or more; learns from labels not held out."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").filter(
        ~F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)))
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs.select(*COLUMNS), model).filter("toxicity < 0.7").select(*COLUMNS)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked ones: that of the smallest doc_id.
    Where a doc_id is null or there twice, all rows first get keys of their own, in
    a written copy, and the smallest key stays: copies that share an id go, and
    another text under the id of a copy stays."""
    docs = docs.select(*COLUMNS)
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("doc_id is null or n > 1")
    if unclear.isEmpty():
        keyed = docs.withColumn("own_id", F.col("doc_id"))
    else:
        keyed = written(docs.withColumnRenamed("doc_id", "own_id")
                        .withColumn("doc_id", F.monotonically_increasing_id()), "keyed")
    found = ngram_join.classes(keyed.select("doc_id", "text"))
    losers = written(found.filter("component_id <> doc_id").select("doc_id").distinct(), "losers")
    maybe = ngram_join.maybe_in(losers)
    # only documents that may be losers are shuffled
    kept = keyed.filter(~maybe).unionByName(keyed.filter(maybe).join(losers, "doc_id", "left_anti"))
    return kept.select(F.col("own_id").alias("doc_id"), *COLUMNS[1:])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences.  The token cache is kept small
    and lasts a task: workers hold memory of the stage before, and the next."""
    return best_fit.pack(docs.select("doc_id", "text"), cache_chunks=100_000, keep_cache=False)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", remove_toxic),
    ("ngram_jaccard", join_near_duplicates),
    ("best_fit_packing", pack_sequences),
]

#: Stages 1 and 2 apply trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
