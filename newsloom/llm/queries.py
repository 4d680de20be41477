"""The registered queries of this subpackage: operators over whole tables, as their contracts have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.near_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), share=(85, 100))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.substring_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.html_extract import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.quality import importance
    from newsloom.llm.scratch import having

    docs = _table(spark, sf_dir, "documents")
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    return importance(docs, having(docs, good, "doc_id"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.nearest import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.fingerprints import edited_fingerprints

    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.llm.toxicity import fit_toxicity, held_out, toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_html_extraction": op2_html_extraction,
    "op3_source_mixing": op3_source_mixing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_fingerprints": op8_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_best_fit_packing": op10_best_fit_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op4_near_duplicates": """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
k AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM documents d JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op5_substring_dedup": """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
v AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM w)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again FROM v),
g AS (
  SELECT p.doc_id, p.i, p.word,
    coalesce(max(CASE WHEN f.again THEN p.i END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), -1) > 0 AS gone
  FROM p LEFT JOIN f ON f.doc_id = p.doc_id AND f.i = p.i),
o AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN o USING (doc_id)""",
}
