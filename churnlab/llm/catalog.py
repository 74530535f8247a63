"""Registered queries of the training-data operators and their SQL twins.

Each query applies one operator with production parameters to its whole table and derives the contract's columns
from the operator's output. Where SQL cannot express an operator, tests/llm compares it with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm import (collocation, cotrain, decontam, hardneg, hilbert, packing, ppm, preference, simhash, topk, toxicity,
                          unigram, wordpiece)
from churnlab.llm.common import fold, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) that overlap, with the best run."""
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "doc_token", "item_token", "run", "equal")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model that never saw the labels of the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=~held)
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Metadata dimensions of the curve.
DIMENSIONS = ["lang", "source", "n_chars"]


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the written runs; the law is ``rows``: shard counts differ by one at most."""
    crc = F.crc32(F.col("text").cast("binary"))
    path = hilbert.write_runs(table(spark, sf_dir, "documents"), DIMENSIONS, [crc, "doc_id"])
    shards = hilbert.read_shards(spark.read.parquet(path))
    return shards.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted preference pairs made of all conversations; spans as "start-stop" text."""
    pairs = preference.pairs_from_conversations(table(spark, sf_dir, "conversations"))
    spans = lambda c: F.concat_ws(";", F.transform(c, lambda x: F.concat_ws("-", x["start"], x["stop"])))
    return preference.format_preferences(pairs).withColumns(
        {c: spans(c) for c in ("chosen_spans", "rejected_spans")})


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents")).drop("text_key")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "p_content", "p_metadata", "score", (F.col("score") >= 0.5).cast("int").alias("keep"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text back."""
    return unigram.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.size("ids").alias("n_ids"), "ids", "decodes")


def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every document by a model that never saw the held-out third."""
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 3) == 1
    return ppm.predict(docs, ppm.fit(docs, allowed=~held)).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; every token of a document bears loss."""
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"), "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hardneg.mine(vectors, vectors.where(F.col("vec_id") % 50 == 0)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocation.best(collocation.collocations(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontamination, op2_exact_topk, op3_toxicity, op4_hilbert_shards, op5_preferences, op6_simhash,
    op7_wordpiece_counts, op8_quality, op9_sentencepiece, op10_ppm_language, op11_packing, op12_hard_negatives,
    op13_collocations)}

ORACLE: dict[str, str] = {
    "op2_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
q AS (SELECT vec_id AS query_id, min(v) AS qv FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
s AS (
  SELECT query_id, vec_id, list_inner_product(qv, v)::BIGINT AS score
  FROM q JOIN v ON vec_id <> query_id AND len(qv) = len(v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_preferences": """
WITH one AS (
  SELECT conv_id, turn, role, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) AS n
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL) WHERE n = 1),
last AS (
  SELECT conv_id, turn AS last_turn, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM one WHERE role = 'assistant')
  WHERE n = 1),
sides AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM one
  UNION ALL
  SELECT o.conv_id, 'rejected', o.turn, o.role, CASE WHEN o.turn = l.last_turn THEN x.text ELSE o.text END
  FROM one o LEFT JOIN last l ON l.conv_id = o.conv_id LEFT JOIN last x ON x.conv_id = xor(o.conv_id, 1)
  WHERE l.last_turn IS NULL OR o.turn < l.last_turn OR (o.turn = l.last_turn AND x.conv_id IS NOT NULL)),
p AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn) AS place,
    '<|' || coalesce(role, 'user') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' || chr(10) AS body
  FROM sides),
d AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id,
    min(CASE WHEN c.pair_id IS NULL OR r.pair_id IS NULL OR c.role IS DISTINCT FROM r.role
             OR c.text IS DISTINCT FROM r.text THEN coalesce(c.place, r.place) END) AS differs,
    count(c.pair_id) AS cn, count(r.pair_id) AS rn
  FROM (SELECT * FROM p WHERE side = 'chosen') c FULL JOIN (SELECT * FROM p WHERE side = 'rejected') r
    ON c.pair_id = r.pair_id AND c.place = r.place GROUP BY 1),
pre AS (SELECT pair_id, coalesce(differs - 1, cn) AS k, cn, rn FROM d),
q AS (
  SELECT p.*, k, sum(CASE WHEN place > k THEN length(head) + length(body) ELSE 0 END)
      OVER (PARTITION BY p.pair_id, side ORDER BY place) - length(body) AS start
  FROM p JOIN pre USING (pair_id)),
g AS (
  SELECT pair_id,
    string_agg(CASE WHEN side = 'chosen' AND place <= k THEN head || body ELSE '' END, '' ORDER BY place) AS prompt,
    string_agg(CASE WHEN side = 'chosen' AND place > k THEN head || body ELSE '' END, '' ORDER BY place) AS chosen,
    string_agg(CASE WHEN side = 'rejected' AND place > k THEN head || body ELSE '' END, '' ORDER BY place) AS rejected,
    string_agg(CASE WHEN side = 'chosen' AND place > k AND role = 'assistant'
                    THEN start || '-' || (start + length(body)) END, ';' ORDER BY place) AS cs,
    string_agg(CASE WHEN side = 'rejected' AND place > k AND role = 'assistant'
                    THEN start || '-' || (start + length(body)) END, ';' ORDER BY place) AS rs
  FROM q GROUP BY pair_id)
SELECT pair_id, k::INT AS prefix_turns, prompt, chosen, rejected, coalesce(cs, '') AS chosen_spans,
  coalesce(rs, '') AS rejected_spans, cn::INT AS chosen_turns, rn::INT AS rejected_turns
FROM g JOIN pre USING (pair_id)""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
a AS (
  SELECT vec_id AS anchor_id, label AS own, v AS av FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY label, v) AS n FROM v WHERE vec_id % 50 = 0) WHERE n = 1),
s AS (
  SELECT anchor_id, vec_id, label = own AS same, list_inner_product(av, v)::BIGINT AS score
  FROM a JOIN v ON vec_id <> anchor_id AND len(av) = len(v)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score, place FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, place ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score::HUGEINT <= 100 * score::HUGEINT
    AND 100 * score::HUGEINT <= 95 * positive_score::HUGEINT)
WHERE rank <= 3""",
    "op13_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
t AS (
  SELECT lang, unnest(list_concat(
    list_transform(range(1, len(w) + 1), lambda i: [w[i]]),
    list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]),
    list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]]))) AS g FROM p),
f AS (SELECT lang, g, count(*) AS f FROM t GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r,
    (1000000 * c.f::HUGEINT * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1 AND f >= 10) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[:k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
weak AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
inside AS (
  SELECT lang, unnest([g[:2], g[2:]]) AS g, f FROM f WHERE len(g) = 3 AND f >= 10),
cover AS (SELECT lang, g, max(f) AS f FROM inside GROUP BY ALL)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, l, r, n, score,
    row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(w.g, ' ')) AS rank
  FROM weak w JOIN n ON n.lang = w.lang LEFT JOIN cover c ON c.lang = w.lang AND c.g = w.g
  WHERE 100 * coalesce(c.f, 0) < 50 * a)
WHERE rank <= 2000""",
}
