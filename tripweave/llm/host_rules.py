"""Host-level quality rules (operator 1), DataFrame functions only.

Each document is measured against a few rules.  Failures are summed by host, the
observed failure rate of each host is shrunk towards the common rate with an
empirical beta prior (fitted to all hosts by moments, so a host with few
documents moves little), and a host whose shrunk rate exceeds a rule's limit is
rejected.  The verdict joins back to the documents.

Sums by host combine map-side, so a host with a third of all documents sends one
row per task.  The host table is joined with a shuffle or broadcast as Spark
sees its size; a hot host is then split by the skew-join handling.

Rows: a null text has no words and fails the base rules; a null source is no
host, so nothing is known against it; an empty table gives no rows; repeated
rows count each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """Rule limits: a document fails a rule, a host fails by its shrunk rate."""

    min_words: int = 50
    max_repeat_pct: int = 50          # words in repeated 3-word windows, of all words
    max_symbols_pct: int = 10         # symbols, of all words
    max_dup_lines_pct: int = 30       # repeated lines, of all words
    host_rate: float = 0.5            # a rejected host fails most of its documents


def _let(value: Column, body) -> Column:
    """``body`` applied to a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, window: int = 3) -> Column:
    """How many words lie in a window of ``window`` words found twice or more.

    Windows are compared by 64-bit hash.  Hashes are sorted, so equal ones stand
    side by side; places of repeated windows are sorted again and their union
    is summed up.  Documents without a repeat stop after the first sort."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - window),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))

    def repeated(pairs: Column) -> Column:
        return F.filter(pairs, lambda p, i: (
            (F.coalesce(F.get(pairs, i - 1)["h"] == p["h"], F.lit(False)))
            | (F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False)))))

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(places, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window)))),
            F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = _let(pairs, lambda p: F.array_sort(F.transform(repeated(p), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(places, covered))

    return F.when(n < window, F.lit(0)).otherwise(_let(hashes, count)).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    length = lambda drop: F.length(F.translate(text, drop, ""))
    return (docs.select("doc_id", "source", F.length(text).alias("chars"),
                        length(SPACES).cast("long").alias("word_chars"),
                        (F.length(text) - length(SYMBOLS)).cast("long").alias("n_symbols"),
                        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                                       repeat_words(w).alias("r"))).alias("w"))
            .select("doc_id", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                    F.col("w.r").alias("n_repeat_words")))


def rules(limits: Limits) -> dict[str, Column]:
    """Rule name -> document fails it."""
    c = F.col
    return {
        "base": (c("n_words") < limits.min_words) | (100 * c("n_repeat_words") > limits.max_repeat_pct * c("n_words")),
        "symbols": 100 * c("n_symbols") > limits.max_symbols_pct * c("n_words"),
        "dup_lines": 100 * c("n_dup_lines") > limits.max_dup_lines_pct * c("n_words"),
    }


def host_verdicts(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(source, n_docs, rate_<rule>..., host_failed): shrunk failure rates."""
    failed = rules(limits)
    hosts = measured.filter("source is not null").groupBy("source").agg(
        F.count("*").alias("n_docs"), *[F.sum(x.cast("long")).alias(f"f_{r}") for r, x in failed.items()])
    # moments of the observed rates over hosts: one row
    raw = {r: F.col(f"f_{r}") / F.col("n_docs") for r in failed}
    prior = hosts.agg(*[f(x).alias(f"{m}_{r}") for r, x in raw.items() for m, f in (("m", F.avg), ("v", F.var_pop))])
    both = hosts.crossJoin(F.broadcast(prior))   # one row
    for r in failed:
        m, v = F.col(f"m_{r}"), F.col(f"v_{r}")
        # m (1 - m) / v - 1 documents' worth of prior; rates that do not vary
        # over hosts carry all the weight there is
        weight = F.when(v > 0, F.greatest(m * (1 - m) / v - 1, F.lit(0.0))).otherwise(F.lit(float("inf")))
        both = both.withColumn(f"rate_{r}", F.when(weight == float("inf"), m).otherwise(
            (F.col(f"f_{r}") + m * weight) / (F.col("n_docs") + weight)))
    over = F.lit(False)
    for r in failed:
        over = over | (F.col(f"rate_{r}") > limits.host_rate)
    return both.select("source", "n_docs", *[f"rate_{r}" for r in failed], over.alias("host_failed"))


def judge(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Documents with base_failed, host_failed and kept.  The measures (a few
    numbers a document) are written first: the texts are read once."""
    measured = written(measured, "measures")
    hosts = host_verdicts(measured, limits).select("source", "host_failed")
    base = rules(limits)["base"]
    return (measured.join(hosts, "source", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), F.coalesce("host_failed", F.lit(False)).alias("host_failed"))
            .withColumn("kept", ~(F.col("base_failed") | F.col("host_failed"))))
