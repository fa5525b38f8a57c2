"""Queries over the standard tables, one per operator: each applies it to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, cascade, decontamination, hard_negatives, html, language, lm_scoring, mixing, periodic, quality, simhash, suffix, toxicity


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    found = lm_scoring.scores(_table(spark, root, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", F.round("log_score", 4).alias("log_score"),
                        F.round("mean_log_score", 6).alias("mean_log_score"))


def op2_simhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, root, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.scores(_table(spark, root, "documents"), _table(spark, root, "labels"))


def op4_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    rows = suffix.cleaned(_table(spark, root, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "kept.n_bytes", "kept.n_removed", "kept.n_spans", F.col("kept.sha256").alias("kept_sha256"))


def op5_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, root, "documents"))
    return mixed.withColumnRenamed("id", "doc_id").select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op6_nearest_neighbours(spark: SparkSession, root: str) -> DataFrame:
    found = ann.search(_table(spark, root, "embeddings"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op7_benchmark_decontamination(spark: SparkSession, root: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, root, "documents"), _table(spark, root, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "n_words", "hamming", "similarity")


def op8_language_id(spark: SparkSession, root: str) -> DataFrame:
    return language.languages(_table(spark, root, "documents"))


def op9_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    return html.extract(_table(spark, root, "pages"))


def op10_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    return quality.scores(_table(spark, root, "documents"), _table(spark, root, "labels"))


def op11_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    rows = _table(spark, root, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", changed), anchors=F.col("vec_id") % 100 == 0)


def op12_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    found = cascade.judged(_table(spark, root, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op13_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    texts = periodic.with_repeated_tails(_table(spark, root, "documents"))
    return periodic.digests(periodic.periodic_runs(texts, id_col="id")).withColumnRenamed("id", "doc_id")


QUERIES = {name: run for name, run in sorted(globals().items()) if name.startswith("op")}

#: What SQL can express. The other results rest on XXH64, learned weights, parsers or random draws, which SQL cannot express.
SQL = {"op1_lm_scoring": r"""
WITH words AS (
  SELECT doc_id, i, list_extract(w, i) AS word, CASE WHEN i > 1 THEN list_extract(w, i - 1) END AS before
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
       LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)),
one AS (SELECT word, count(*) AS n FROM words GROUP BY word),
own AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word),
two AS (SELECT before, word, count(*) AS n FROM words WHERE before IS NOT NULL GROUP BY before, word),
mine AS (SELECT doc_id, before, word, count(*) AS n FROM words WHERE before IS NOT NULL GROUP BY doc_id, before, word),
size AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, ln(greatest((o.n - ow.n)::DOUBLE, 0.4) / greatest((SELECT count(*) FROM words) - s.n, 1)) AS single,
         t.n - m.n AS pair, p.n - pw.n AS history
  FROM words w JOIN one o USING (word) JOIN own ow ON ow.doc_id = w.doc_id AND ow.word = w.word JOIN size s ON s.doc_id = w.doc_id
  LEFT JOIN two t ON t.before = w.before AND t.word = w.word
  LEFT JOIN mine m ON m.doc_id = w.doc_id AND m.before = w.before AND m.word = w.word
  LEFT JOIN one p ON p.word = w.before LEFT JOIN own pw ON pw.doc_id = w.doc_id AND pw.word = w.before),
summed AS (
  SELECT doc_id, count(*) AS n_words,
         sum(CASE WHEN pair IS NULL THEN single WHEN pair > 0 THEN ln(pair::DOUBLE / history) ELSE ln(0.4::DOUBLE) + single END) AS total
  FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, round(coalesce(total, 0), 4) AS log_score,
       round(coalesce(total / n_words, 0), 6) AS mean_log_score
FROM documents d LEFT JOIN summed s ON s.doc_id = d.doc_id
""",
    "op11_hard_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
found AS (
  SELECT p.anchor_id, positive_id, n.vec_id AS negative_id, positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
""",
    "op12_quality_rules": r"""
WITH texts AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
placed AS (SELECT row_number() OVER () AS r, * FROM texts),
windows AS (
  SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM placed)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
stats AS (
  SELECT doc_id, t, w, l, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(l) AS n_lines,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM placed LEFT JOIN covered c USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words
         OR 2 * n_dup_lines > n_lines
         OR 5 * len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < 4 * n_words
         OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}'))) > n_words
         OR 2 * length(regexp_replace(t, '[^!?]', '', 'g')) > n_words
         OR 10 * len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) > 9 * n_lines
         OR 10 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) > 3 * n_lines
         OR 50 * len(list_distinct(w)) < n_words) AS kept
FROM based
"""}
