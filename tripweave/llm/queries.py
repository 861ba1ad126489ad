"""The driver queries of the operators, over whole tables, and the SQL of those
that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (best_fit, bpe_codec, chat_format, embed_dedup, host_rules, language_id, license_scan,
                           ngram_join, passage_dedup, prefix_trie, ranked_search, token_files, toxicity)
from tripweave.llm.common import read_table, remainder


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(host_rules.measure(read_table(spark, sf_dir, "documents", "doc_id", "text", "source")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
    model = language_id.train(docs.filter("not held_out"))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"), in_window=True)


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(bpe_codec.encode(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(more)))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_files(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return token_files.read_digests(spark, path)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = toxicity.train(docs, labels.filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.dedup(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return ranked_search.search(index, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = passage_dedup.remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return docs.select("doc_id", size.alias("n_bytes"), (size - F.length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.positions(rows)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_quality_rules, op2_language_id, op3_license_scan, op4_bpe_codec, op5_ngram_jaccard, op6_chat_format,
           op7_best_fit_packing, op8_token_files, op9_toxicity, op10_embedding_dedup, op11_ranked_search, op12_suffix_dedup,
           op13_prefix_trie)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
grams AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
  FROM words WHERE len(w) >= 3),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) x, (VALUES (0), (1), (2)) k(k)
  WHERE c > 1 GROUP BY r),
measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(text, chr(10)),
                                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN repeated USING (r)),
failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words AS f_symbols, 100 * n_dup_lines > 30 * n_words AS f_dup FROM measured),
rates AS (
  SELECT source, rule, count(*) AS n, sum(CAST(f AS BIGINT)) AS f
  FROM (SELECT source, unnest(['base', 'symbols', 'dup']) AS rule,
               unnest([base_failed, f_symbols, f_dup]) AS f FROM failed WHERE source IS NOT NULL) x
  GROUP BY source, rule),
prior AS (SELECT rule, avg(f / n) AS m, var_pop(f / n) AS v FROM rates GROUP BY rule),
hosts AS (
  SELECT source, max(CASE WHEN v > 0
      THEN (f + m * greatest(m * (1 - m) / v - 1, 0)) / (n + greatest(m * (1 - m) / v - 1, 0)) ELSE m END) > 0.5
      AS host_failed
  FROM rates JOIN prior USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(host_failed, false) AS host_failed, NOT (base_failed OR coalesce(host_failed, false)) AS kept
FROM failed LEFT JOIN hosts USING (source)
"""


OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sized AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM docs WHERE len(w) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sized),
posts AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM sized) x GROUP BY r, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt
  FROM posts, total GROUP BY t, nd),
items AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
scored AS (
  SELECT q, item_id, r, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt)))) AS BIGINT) AS score
  FROM (SELECT q, item_id, unnest(w) AS t FROM items) i JOIN weights USING (t) JOIN posts USING (t)
  JOIN (SELECT r, n FROM sized) s USING (r), total
  GROUP BY q, item_id, r),
ranked AS (
  SELECT q, item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
  FROM scored JOIN (SELECT r, doc_id FROM sized) s USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

OP13 = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(i AS BIGINT) FOR i IN range(8)]),
      lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns) x),
rebuilt AS (
  SELECT v.c, 0 AS part, pos, role, text FROM convs v JOIN turns t ON t.c = v.base AND pos <= h
  UNION ALL
  SELECT v.c, 1, pos, role, text FROM convs v JOIN turns t ON t.c = v.c AND pos > h),
paths AS (
  SELECT convs.c, coalesce(list({'r': role, 't': text} ORDER BY part, pos) FILTER (WHERE part IS NOT NULL), []) AS p
  FROM convs LEFT JOIN rebuilt ON rebuilt.c = convs.c GROUP BY convs.c),
nodes AS (
  SELECT d, p[1:d] AS p, min(c) AS rep, count(*) AS n_convs, list(c ORDER BY c) FILTER (WHERE len(p) = d) AS ends
  FROM (SELECT c, p, unnest(range(len(p) + 1)) AS d FROM paths) x GROUP BY d, p[1:d]),
children AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
named AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children, coalesce((n_convs - 1) * strlen(nodes.p[nodes.d].t), 0) AS saves
  FROM nodes LEFT JOIN children ON children.d = nodes.d AND children.p = nodes.p),
below AS (
  SELECT v.d, v.p, CAST(sum(u.saves) AS BIGINT) AS saved, count_if(u.n_children = 0) AS leaves
  FROM named v JOIN named u ON u.p[1:v.d] = v.p AND u.d >= v.d GROUP BY v.d, v.p)
SELECT v.rep AS conv_id, v.d AS depth, up.rep AS parent_conv_id, v.n_convs, v.n_children,
       CAST(leaves AS BIGINT) AS n_leaves, saved AS saved_tokens,
       sha256(coalesce(array_to_string(v.ends, ','), '')) AS ends_sha256
FROM named v JOIN below b ON b.d = v.d AND b.p = v.p
LEFT JOIN nodes up ON up.d = v.d - 1 AND up.p = v.p[1:v.d - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op11_ranked_search": OP11, "op13_prefix_trie": OP13}
