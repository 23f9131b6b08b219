"""Queries of this subpackage, one per operator, with SQL where DuckDB can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.llm import (bpe, clustering, decontamination, extraction, jaccard, languages, licences, negatives, packing, secrets, substrings,
                            topk, toxicity)
from tallyridge.llm.tables import read


def op1_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = languages.learn(docs.where(~languages.held_out()))
    found = languages.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


def op4_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), decontamination.Settings(short_items=True))


def op5_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return packing.pack(read(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


def op7_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op9_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_pivot_distance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op11_bpe_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN, path

    ranks = path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(read(spark, sf_dir, "documents"), ranks, PATTERN, ["doc_id"])
    coded = coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))
    text = bpe.decode(coded, ranks, ["doc_id", "n_tokens", "ids_sha256"])
    return text.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_tree_bound_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.cluster(read(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


NEGATIVES_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3"""


def clusters_sql(rounds: int = 3) -> str:
    """Plain assignment and means, one pair of statements per round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(v.e) AS e, min({{'d': (list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e))::BIGINT, 'c': c.c}}) AS near
  FROM v CROSS JOIN c{r} c GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  WITH parts AS (SELECT near.c AS c, j, sum(e[j])::BIGINT AS s, count(*) AS n FROM a{r} CROSS JOIN range(1, 65) t(j) GROUP BY 1, 2),
  means AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS e FROM parts GROUP BY 1)
  SELECT c{r}.c, coalesce(means.e, c{r}.e) AS e FROM c{r} LEFT JOIN means ON means.c = c{r}.c)""")
    body = ",\n".join(steps)
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INT AS c, e FROM v QUALIFY c < 16),
{body}
SELECT vec_id, near.c AS cluster, near.d AS distance, (sum(near.d) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia,
  (sum(near.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c{rounds}.e, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = near.c"""


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
passages AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 18), lambda i: {'start': i, 'h': sha256(array_to_string(ws[i:i + 19], ' '))})) AS p FROM w WHERE len(ws) >= 20),
later AS (SELECT doc_id, start FROM (SELECT doc_id, p.start AS start, row_number() OVER (PARTITION BY p.h ORDER BY doc_id, p.start) AS place FROM passages) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS text, count(gone.i) AS n_removed
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

LINKS_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents WHERE text IS NOT NULL),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: md5(array_to_string(ws[i:i + 2], ' ')))
  WHEN len(ws) > 0 THEN [md5(array_to_string(ws, ' '))] ELSE [] END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reached(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS component_id FROM reached GROUP BY 1),
numbers AS (SELECT x, count(*) AS n_links FROM links GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.x = d.doc_id LEFT JOIN numbers ON numbers.x = d.doc_id"""

QUERIES: tuple[Callable, ...] = (op1_repeated_phrases, op2_token_group_join, op3_toxicity, op4_cgk_decontamination, op5_tag_path_ratios, op6_harmonic_packing, op7_licence_sentences,
                                 op8_language_mixture, op9_secret_trigrams, op10_pivot_distance_topk, op11_bpe_matrices, op12_tree_bound_negatives,
                                 op13_va_file_clusters)
SQL: dict[str, str] = {"op1_repeated_phrases": REPEATS_SQL, "op2_token_group_join": LINKS_SQL,
                       "op7_licence_sentences": licences.oracle_sql(), "op9_secret_trigrams": secrets.oracle_sql(),
                       "op10_pivot_distance_topk": TOPK_SQL, "op12_tree_bound_negatives": NEGATIVES_SQL, "op13_va_file_clusters": clusters_sql()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
