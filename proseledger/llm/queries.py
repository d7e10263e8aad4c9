"""One registered query per operator, over the whole table, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.query import Query, table
from . import (
    decontaminate, fill_middle, hard_negatives, licenses, line_dedup, lm_score, ngram_join, packing, pii, quality,
    set_sketch, sharding, suffix_dedup,
)
from .common import documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def run_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, folder)).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id"
    )


def run_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), TOKENIZER).select(
        F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def run_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as files: a folder per source, in it one per language.

    A document that speaks of a licence is a licence file of its folder, so the others there may inherit.
    """
    number = F.col("doc_id").cast("string")
    name = F.when(F.col("text").rlike(r"\b[Ll]icen[cs]e"), F.concat(F.lit("LICENSE-"), number)).otherwise(number)
    files = documents(spark, folder).select("doc_id", "text", F.concat_ws("/", "source", "lang", name).alias("path"))
    return licenses.scan_licenses(files).select(
        "doc_id", "path", "licence", F.round("cosine", 6).alias("cosine"), "origin"
    )


def run_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, folder))
    count = lambda kind: F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.joined(F.col("pii_base")), 256).alias("base_sha256"),
        pii.joined(F.col("pii_spans")).alias("spans"),
        F.array_join(F.transform("pii_spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def run_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated runs of lines of eight words together, and repeated single lines of eight words."""
    return line_dedup.dedup_lines(documents(spark, folder), single_words=8).select(
        "doc_id", "n_lines", "n_deleted",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def run_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeated(documents(spark, folder)).select(
        F.col("_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def run_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    leaks = decontaminate.find_leaks(documents(spark, folder), table(spark, folder, "benchmark"))
    return leaks.select(
        F.col("_id").alias("doc_id"), F.col("item").alias("item_id"),
        *[F.round(c, 6).alias(c) for c in ("score", "question_overlap", "answer_overlap")],
    )


def run_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"),
    )


def run_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_texts(documents(spark, folder)).withColumnRenamed("_id", "doc_id")


def run_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, folder)).select(
        F.col("_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def run_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the ids divisible by 100; every seventh id's label is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


def run_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.fill_in_middle(documents(spark, folder)))
    return made.select(
        F.col("_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def run_set_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return set_sketch.near_duplicates(documents(spark, folder)).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words)
), sizes AS (
  SELECT w.doc_id, count(s.s) AS n FROM words w LEFT JOIN shingles s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT s.doc_id, s.n AS n_shingles, min(r.y) AS component_id
FROM sizes s JOIN reach r ON r.x = s.doc_id GROUP BY 1, 2
"""

LINE_DEDUP_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents
), lines AS (
  SELECT doc_id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS place FROM split
), bare AS (
  SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS l FROM lines
), numbered AS (
  SELECT doc_id, place, l, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i,
    len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM bare WHERE l <> ''
), runs AS (
  SELECT doc_id, i, n, n + lead(n) OVER w AS words, l AS one, lead(l) OVER w AS two
  FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), firsts AS (
  SELECT *, first_value(doc_id) OVER w AS first_doc, first_value(i) OVER w AS first_i
  FROM runs WHERE two IS NOT NULL WINDOW w AS (PARTITION BY one, two ORDER BY doc_id, i)
), stretches AS (
  SELECT *, i - first_i AS shift,
    i - row_number() OVER (PARTITION BY doc_id, first_doc, i - first_i ORDER BY i) AS stretch
  FROM firsts WHERE doc_id <> first_doc OR i <> first_i
), matches AS (
  SELECT doc_id, min(CASE WHEN doc_id = first_doc THEN greatest(i, first_i + 2) ELSE i END) AS a, max(i) + 2 AS b
  FROM stretches GROUP BY doc_id, first_doc, shift, stretch
  HAVING sum(n) - arg_max(n, i) + arg_max(words, i) >= 8
), singles AS (
  SELECT doc_id, i FROM numbered WHERE n >= 8
  QUALIFY row_number() OVER (PARTITION BY l ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b)) AS i FROM matches UNION SELECT doc_id, i FROM singles
), marked AS (
  SELECT b.doc_id, b.place, b.line, g.i IS NOT NULL AS deleted
  FROM bare b LEFT JOIN numbered n ON n.doc_id = b.doc_id AND n.place = b.place
  LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.i = n.i
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (deleted) AS n_deleted,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT deleted), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

HARD_NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

FILL_MIDDLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || doc_id) AS d
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
    ('0x' || d[25:32])::BIGINT AS h4
  FROM units
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:n], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

SET_SKETCH_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))
      ELSE w END) AS s
    FROM words)
), sizes AS (
  SELECT w.doc_id, count(s.s) AS n FROM words w LEFT JOIN shingles s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT s.doc_id, s.n AS n_shingles, min(r.y) AS component_id, min(r.y) = s.doc_id AS kept
FROM sizes s JOIN reach r ON r.x = s.doc_id GROUP BY 1, 2
"""

QUERIES: dict[str, Query] = {
    "op1_ngram_join": Query(run_ngram_join, NGRAM_JOIN_SQL),
    "op2_packing": Query(run_packing),
    "op3_license_scan": Query(run_licenses),
    "op4_personal_data": Query(run_pii),
    "op5_line_dedup": Query(run_line_dedup, LINE_DEDUP_SQL),
    "op6_suffix_dedup": Query(run_suffix_dedup),
    "op7_decontaminate": Query(run_decontaminate),
    "op8_quality_rules": Query(run_quality),
    "op9_lm_score": Query(run_lm_score),
    "op10_shard_by_bytes": Query(run_sharding),
    "op11_hard_negatives": Query(run_hard_negatives, HARD_NEGATIVES_SQL),
    "op12_fill_middle": Query(run_fill_middle, FILL_MIDDLE_SQL),
    "op13_set_sketch": Query(run_set_sketch, SET_SKETCH_SQL),
}
