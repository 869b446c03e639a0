"""Catalogue plans: documents stand for products, conversations for reviews, pages for pictures.

Texts and vectors come from the offline providers, so SQL can state what they answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.prompts import ALT_TEXT_PROMPT, DESCRIPTION_PROMPT, REVIEW_PROMPT, REPORT_PROMPT
from tidemark.functions.scalars import json_scalar
from tidemark.operators.enrich import OfflineEmbedding, OfflineText, generate_per_group
from tidemark.operators.grouping import nested_parts, text_digest
from tidemark.operators.ranking import ONE_TASK_ROWS
from tidemark.operators.similarity import nearest, pair_table, score_pairs
from tidemark.operators.reshape import union_by_name
from tidemark.operators.vector_index import build_index, open_index, probes_for, recall, search_index
from tidemark.plans import catalog as plan
from tidemark.registry.common import rounded
from tidemark.session import materialize, scratch_path
from tidemark.sources.readers import read_table

BRANDS = {f"src{i}": f"Source {i}" for i in range(15)}
WEB, STORE, FOLDER = "https://files.example.com/shop", "store://shop", "images"


def products(spark, sf) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    rows = docs.select(
        F.col("doc_id").cast("string").alias("key"),
        F.col("source").alias("brand"),
        F.concat(F.lit("Item "), "doc_id").alias("name"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("subhead"),
        F.col("text").alias("description"),
        F.when(F.col("n_chars") < 600, F.col("source")).alias("ingredients"),
    )
    return plan.with_links(rows, WEB, STORE, FOLDER, BRANDS)


def reviews(spark, sf) -> DataFrame:
    talks = read_table(spark, sf, "conversations")
    labels = read_table(spark, sf, "labels").withColumnRenamed("doc_id", "conv_id")
    return talks.join(labels, "conv_id", "left").select(
        F.col("conv_id").cast("string").alias("key"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).alias("date"),
        (F.col("quality") * 4 + 1).alias("stars"),
        F.when(F.col("role") != "system", F.concat(F.lit("Turn "), "turn")).alias("title"),
        F.col("role").alias("author"),
        F.col("turn").alias("helpful_yes"),
        F.coalesce("toxic", F.lit(0)).alias("helpful_no"),
        "text",
    )


def pictures(spark, sf) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    return pages.select(F.concat(F.lit(f"{STORE}/{FOLDER}/"), "page_id", F.lit(".png")).alias("uri"))


def thread_digest(spark, sf, one_task_rows=ONE_TASK_ROWS):
    """All turns of a conversation as one text, last turn first."""
    talks = read_table(spark, sf, "conversations")
    line = F.concat("role", F.lit(": "), "text")
    return text_digest(talks, ["conv_id"], line, "turn", 1000, "thread", "\n\n", True, one_task_rows=one_task_rows)


def thread_digest_split(spark, sf):
    """The same with every conversation of several turns counted as a large group."""
    return thread_digest(spark, sf, 1)


def thread_digest_parts(spark, sf):
    """The same in order, three turns to a part."""
    talks = read_table(spark, sf, "conversations")
    line = F.concat("role", F.lit(": "), "text")
    return text_digest(talks, ["conv_id"], line, "turn", 3, "thread", "\n\n")


def review_stats(spark, sf):
    return rounded(plan.review_stats(reviews(spark, sf)), {"avg_rating": 9})


def review_digests(spark, sf):
    return plan.review_digests(reviews(spark, sf))


def catalog_short_descriptions(spark, sf):
    rows = plan.with_short_descriptions(products(spark, sf), OfflineText)
    return rows.select("key", "brand_and_product_name", "image_link", "short_description_status", "short_description_result")


def catalog_alt_texts(spark, sf):
    return plan.image_alt_texts(pictures(spark, sf), OfflineText).drop("alt_text_json")


def _assembled(spark, sf) -> DataFrame:
    facts = reviews(spark, sf)
    summaries = plan.with_review_summaries(plan.review_digests(facts), OfflineText)
    return plan.assemble(
        plan.with_short_descriptions(products(spark, sf), OfflineText),
        plan.image_alt_texts(pictures(spark, sf), OfflineText),
        plan.review_stats(facts),
        summaries,
    )


def catalog_assembled(spark, sf):
    rows = _assembled(spark, sf).drop("num_texts", "description", "subhead", "ingredients")
    return rounded(rows, {"avg_rating": 9})


def embedding_outer_join(spark, sf):
    """Vectors of the description and of the reviews, for keys present on either side."""
    items = products(spark, sf).withColumn("short_description_result", F.col("description"))
    talks = plan.review_digests(reviews(spark, sf)).select(
        "key", F.lit(None).cast("string").alias("brand_and_product_name"), F.col("all_reviews_concat").alias("review_summary_result")
    )
    both = plan.product_embeddings(items, talks, OfflineEmbedding)
    dot = F.aggregate(
        F.zip_with("short_description_embedding", "review_summary_embedding", lambda a, b: a * b),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    out = both.withColumn("dot", dot).drop(
        "short_description", "review_summary", "short_description_embedding", "review_summary_embedding"
    )
    return rounded(out, {"dot": 6})


def json_value_extract(spark, sf):
    events = read_table(spark, sf, "events")
    nested = F.concat(F.lit('{"a": '), "props", F.lit(', "t": "'), "event_type", F.lit('"}'))
    return events.select(
        "event_id",
        json_scalar("props", "$.k").alias("k"),
        json_scalar(nested, "$.a.k").alias("nested_k"),
        json_scalar(nested, "$.a").alias("object_is_null"),
        json_scalar(nested, "$.t").alias("t"),
    )


def grouped_request(spark, sf):
    """One answer per page language over all its pages, 300 to a request."""
    pages = read_table(spark, sf, "pages").withColumn("lang", F.regexp_extract("html", '<html lang="([a-z]+)"', 1))
    asked = generate_per_group(pages, ["lang"], "url", "page_id", F.lit(REPORT_PROMPT), OfflineText, "report")
    return asked.drop("report_json")


def grouped_request_parts(spark, sf):
    """The same with 20 pages to a request: still one answer per language, over the answers of its parts."""
    pages = read_table(spark, sf, "pages").withColumn("lang", F.regexp_extract("html", '<html lang="([a-z]+)"', 1))
    asked = generate_per_group(pages, ["lang"], "url", "page_id", F.lit(REPORT_PROMPT), OfflineText, "report", files_per_request=20)
    return asked.drop("report_json")


def order_lines_nested(spark, sf):
    """Lines of each order nested in order of shipping, written out as text."""
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", F.unix_date(F.to_date("l_shipdate")).alias("day"))
    nested = nested_parts(lines, ["l_orderkey"], "day", 1000, ["l_partkey"], "lines", tie_break=[("l_partkey", False)])
    listed = F.array_join(F.transform("lines", lambda r: r["l_partkey"].cast("string")), ",")
    return nested.select("l_orderkey", "part", listed.alias("parts"))


def _vectors(spark, sf):
    return read_table(spark, sf, "embeddings")


def vector_topk(spark, sf):
    base = _vectors(spark, sf)
    return nearest(base, base, "vec_id", "embedding", 10)


def vector_topk_blocks(spark, sf):
    """The same search through many small cells; the result must not depend on them."""
    base = _vectors(spark, sf)
    return nearest(base, base, "vec_id", "embedding", 10, block_rows=256)


def similarity_scores(spark, sf):
    base = _vectors(spark, sf)
    pairs = nearest(base, base, "vec_id", "embedding", 20, keep_self=True)
    return rounded(score_pairs(pairs, "description"), {"description_score": 6})


def product_pairs(spark, sf):
    """Two searches side by side: the vectors, and the vectors of half their length."""
    base = _vectors(spark, sf)
    halves = base.withColumn("half", F.slice("embedding", 1, 32))
    first = score_pairs(nearest(base, base, "vec_id", "embedding", 5, keep_self=True), "full")
    second = score_pairs(nearest(halves, halves, "vec_id", "half", 5, keep_self=True), "half")
    pairs = pair_table(base.select("vec_id", "label"), "vec_id", [first, second])
    return rounded(pairs, {"full_score": 6, "half_score": 6})


def vector_index_topk(spark, sf):
    """The search through the stored index with every cell probed: what an exact search finds."""
    base = _vectors(spark, sf)
    path = scratch_path(spark, "index")
    build_index(base, "vec_id", "embedding", path)
    index = open_index(spark, path)
    return search_index(index, base, "vec_id", "embedding", 10, probes=len(index.centres))


def vector_index_recall(spark, sf):
    """Recall of the stored index at two measured numbers of probed cells, against the exact search of every row."""
    base = _vectors(spark, sf)
    index = build_index(base, "vec_id", "embedding", scratch_path(spark, "index"))
    exact = materialize(nearest(base, base, "vec_id", "embedding", 10), "exact")
    rows = []
    for target in (0.91, 0.97):
        probes = probes_for(index, base, "vec_id", "embedding", 10, target)
        found = recall(search_index(index, base, "vec_id", "embedding", 10, probes), exact)
        rows.append(found.select(F.lit(target).alias("target"), "queries", "wanted", (F.col("recall") >= 0.9).alias("reached")))
    return union_by_name(*rows)


QUERIES = {
    f.__name__: f
    for f in (
        thread_digest, thread_digest_split, thread_digest_parts, review_stats, review_digests, catalog_short_descriptions,
        catalog_alt_texts, catalog_assembled, embedding_outer_join, json_value_extract, grouped_request, grouped_request_parts,
        order_lines_nested, vector_topk, vector_topk_blocks, similarity_scores, product_pairs,
        vector_index_topk, vector_index_recall,
    )
}


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, *fields: str) -> str:
    """SQL concatenation of a template with its fields."""
    pieces = template.split("%s")
    out = [_lit(pieces[0])]
    for field, piece in zip(fields, pieces[1:]):
        out += [field, _lit(piece)]
    return "(" + " || ".join(out) + ")"


def _answer(prompt: str) -> str:
    return f"(length({prompt}) || ' characters in ' || (length({prompt}) - length(replace({prompt}, chr(10), '')) + 1) || ' lines')"


_BRANDS = "CASE brand " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BRANDS.items()) + " END"
_PRODUCTS = f"""
p0 AS (
  SELECT CAST(doc_id AS VARCHAR) AS key, source AS brand, 'Item ' || doc_id AS name,
         CASE WHEN lang <> 'en' THEN lang END AS subhead, text AS description,
         CASE WHEN n_chars < 600 THEN source END AS ingredients FROM documents
),
p1 AS (
  SELECT *, {_BRANDS} AS brand_name, '{WEB}/{FOLDER}/' || key || '.png' AS image_link,
         '{STORE}/{FOLDER}/' || key || '.png' AS image_uri FROM p0
),
products AS (
  SELECT *, brand_name || ' ' || name AS brand_and_product_name,
         '' AS short_description_status,
         {_answer(_filled(DESCRIPTION_PROMPT, "coalesce(name, '')", "coalesce(subhead, '')", "coalesce(description, '')"))}
           AS short_description_result
  FROM p1
)"""
_REVIEWS = """
reviews AS (
  SELECT CAST(conv_id AS VARCHAR) AS key, DATE '2024-01-01' + CAST(turn AS INTEGER) AS date, quality * 4 + 1 AS stars,
         CASE WHEN role <> 'system' THEN 'Turn ' || turn END AS title, role AS author, turn AS helpful_yes,
         coalesce(toxic, 0) AS helpful_no, text
  FROM conversations LEFT JOIN labels ON conv_id = doc_id
),
stats AS (
  SELECT key, avg(stars) AS avg_rating, count(stars) AS num_ratings, min(date) AS first_review_date,
         max(date) AS last_review_date FROM reviews GROUP BY key
),
digests AS (
  SELECT key, CAST(0 AS BIGINT) AS part, CAST(count(t) AS INTEGER) AS num_texts,
         string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY helpful_yes - helpful_no DESC, date DESC, author, text) AS all_reviews_concat
  FROM (SELECT *, '"' || title || '"' || chr(10) || 'Stars: ' || stars || chr(10) || 'Author: ' || author || chr(10)
                  || 'Date: ' || strftime(date, '%b %d, %Y') || chr(10) || chr(10) || text AS t FROM reviews)
  WHERE t IS NOT NULL GROUP BY key
)"""
_LETTERS = (
    "list_transform(range(97, 123), lambda c: CAST(length(lower({t})) - length(replace(lower({t}), chr(CAST(c AS INTEGER)), '')) AS DOUBLE))"
)


def _embedded(alias: str, table: str, text: str, name: str) -> str:
    return f"""
{alias}0 AS (SELECT key, {text} AS t, {name} AS nm, {_LETTERS.format(t=text)} AS v FROM {table}),
{alias} AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len,
  length(t) - length(replace(t, ' ', '')) + 1 AS tokens FROM {alias}0)"""


_ALL_PAIRS = """
pairs AS (
  SELECT a.vec_id AS q, b.vec_id AS b,
         CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE greatest(round(list_cosine_distance({a}, {b}), 9), 0) END AS d
  FROM embeddings a, embeddings b
)"""


def _pairs(start: int = 1, end: int = 64) -> str:
    def part(x):
        return f"CAST({x}.embedding[{start}:{end}] AS DOUBLE[])"

    return _ALL_PAIRS.replace("{a}", part("a")).replace("{b}", part("b"))


def _scored(prefix: str, source: str, k: int) -> str:
    return f"""
{prefix}_top AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, b) <= {k}),
{prefix}_s AS (
  SELECT q AS query_key, b AS base_key, d + 0.0 AS {prefix}_distance,
         rank() OVER (ORDER BY d) AS {prefix}_ovr_rk, count(*) OVER () AS {prefix}_ovr_num,
         round((count(*) OVER () - rank() OVER (ORDER BY d) + 0.5) / count(*) OVER () * 100, 6) AS {prefix}_score,
         CASE WHEN q <> b THEN CAST(rank() OVER (PARTITION BY q, q = b ORDER BY d) AS INTEGER) END AS {prefix}_query_rk
  FROM {prefix}_top
)"""


_TOPK = f"""WITH {_pairs()}
SELECT q AS query_key, b AS base_key, d + 0.0 AS distance,
       CAST(row_number() OVER (PARTITION BY q ORDER BY d, b) AS INTEGER) AS neighbor_rk
FROM pairs WHERE q <> b QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, b) <= 10"""

def _grouped(size: int) -> str:
    """One answer per language; the answers of several parts are asked about again as one text."""
    return f"""
WITH p AS (
  SELECT *, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
         (rank() OVER (PARTITION BY regexp_extract(html, '<html lang="([a-z]+)"', 1) ORDER BY page_id) - 1) // {size} AS part FROM pages
), a AS (
  SELECT lang, part, {_answer(_lit(REPORT_PROMPT))} || ', ' || count(*) || ' files' AS answer FROM p GROUP BY lang, part
), g AS (
  SELECT lang, count(*) AS n, min(answer) AS one, {_lit(REPORT_PROMPT)} || chr(10) || chr(10) || string_agg(answer, chr(10) || chr(10) ORDER BY part) AS again
  FROM a GROUP BY lang)
SELECT lang, '' AS report_status, CASE WHEN n = 1 THEN one ELSE {_answer('again')} END AS report_result FROM g"""


_THREADS = """
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS num_texts,
       string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn DESC) AS thread FROM conversations GROUP BY conv_id"""

SQL = {
    "thread_digest": _THREADS,
    "thread_digest_split": _THREADS,
    "thread_digest_parts": """
WITH t AS (SELECT *, (rank() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS part FROM conversations)
SELECT conv_id, part, CAST(count(*) AS INTEGER) AS num_texts,
       string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn) AS thread FROM t GROUP BY conv_id, part""",
    "review_stats": f"WITH {_REVIEWS} SELECT * REPLACE (round(avg_rating, 9) AS avg_rating) FROM stats",
    "review_digests": f"WITH {_REVIEWS} SELECT * FROM digests",
    "catalog_short_descriptions": f"""WITH {_PRODUCTS}
SELECT key, brand_and_product_name, image_link, short_description_status, short_description_result FROM products""",
    "catalog_alt_texts": f"""
SELECT '{STORE}/{FOLDER}/' || page_id || '.png' AS uri, '' AS alt_text_status,
       {_answer(_lit(ALT_TEXT_PROMPT))} || ', 1 files' AS alt_text_result FROM pages""",
    "catalog_assembled": f"""WITH {_PRODUCTS}, {_REVIEWS}
SELECT p.key, brand, name, brand_name, image_link, image_uri, brand_and_product_name,
       short_description_status, short_description_result,
       CASE WHEN page_id IS NOT NULL THEN '' END AS alt_text_status,
       CASE WHEN page_id IS NOT NULL THEN {_answer(_lit(ALT_TEXT_PROMPT))} || ', 1 files' END AS alt_text_result,
       round(avg_rating, 9) AS avg_rating, num_ratings, first_review_date, last_review_date, all_reviews_concat,
       CASE WHEN d.key IS NOT NULL THEN '' END AS review_summary_status,
       CASE WHEN d.key IS NOT NULL THEN {_answer(_filled(REVIEW_PROMPT, "all_reviews_concat"))} END AS review_summary_result,
       brand_and_product_name || coalesce(chr(10) || subhead, '') || coalesce(chr(10) || chr(10) || description, '')
       || coalesce(chr(10) || chr(10) || 'Ingredients: ' || ingredients, '')
       || CASE WHEN all_reviews_concat IS NULL THEN '' ELSE
            chr(10) || chr(10) || 'All ' || num_ratings || ' Reviews:' || chr(10) || chr(10) || all_reviews_concat END
       AS product_all_provided_info
FROM products p LEFT JOIN pages ON image_uri = '{STORE}/{FOLDER}/' || page_id || '.png'
LEFT JOIN stats s ON s.key = p.key LEFT JOIN digests d ON d.key = p.key""",
    "embedding_outer_join": f"""WITH {_PRODUCTS}, {_REVIEWS},
{_embedded("a", "products", "description", "brand_and_product_name")},
{_embedded("b", "digests", "all_reviews_concat", "CAST(NULL AS VARCHAR)")}
SELECT coalesce(a.key, b.key) AS key, coalesce(a.nm, b.nm) AS brand_and_product_name,
       CASE WHEN a.key IS NOT NULL THEN '' END AS short_description_embedding_status,
       CAST(a.tokens AS INTEGER) AS short_description_embedding_token_count,
       CASE WHEN a.key IS NOT NULL THEN FALSE END AS short_description_embedding_truncated,
       CASE WHEN a.key IS NOT NULL THEN CASE WHEN a.len > 0 THEN 26 ELSE 0 END END AS short_description_embedding_length,
       CASE WHEN b.key IS NOT NULL THEN '' END AS review_summary_embedding_status,
       CAST(b.tokens AS INTEGER) AS review_summary_embedding_token_count,
       CASE WHEN b.key IS NOT NULL THEN FALSE END AS review_summary_embedding_truncated,
       CASE WHEN b.key IS NOT NULL THEN CASE WHEN b.len > 0 THEN 26 ELSE 0 END END AS review_summary_embedding_length,
       round(list_dot_product(a.v, b.v) / nullif(a.len * b.len, 0), 6) AS dot
FROM a FULL JOIN b ON a.key = b.key""",
    "json_value_extract": """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k') AS nested_k,
       CAST(NULL AS VARCHAR) AS object_is_null, event_type AS t FROM events""",
    "grouped_request": _grouped(300),
    "grouped_request_parts": _grouped(20),
    "order_lines_nested": """
SELECT l_orderkey, CAST(0 AS BIGINT) AS part,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_shipdate, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey""",
    "vector_topk": _TOPK,
    "vector_topk_blocks": _TOPK,
    "vector_index_topk": _TOPK,
    "vector_index_recall": """
SELECT target, count(*) AS queries, sum(least(10, n - 1))::BIGINT AS wanted, TRUE AS reached
FROM embeddings, (SELECT count(*) AS n FROM embeddings), (SELECT unnest([0.91::DOUBLE, 0.97::DOUBLE]) AS target) GROUP BY target""",
    "similarity_scores": f"WITH {_pairs()}, {_scored('description', 'pairs', 20)} SELECT * FROM description_s",
    "product_pairs": f"""WITH {_pairs()}, {_pairs(1, 32).replace("pairs AS", "half_pairs AS")},
{_scored("full", "pairs", 5)}, {_scored("half", "half_pairs", 5)}
SELECT coalesce(f.query_key, h.query_key) AS vec_id_1, coalesce(f.base_key, h.base_key) AS vec_id_2,
       full_distance, full_ovr_rk, full_ovr_num, full_score, full_query_rk,
       half_distance, half_ovr_rk, half_ovr_num, half_score, half_query_rk,
       e1.label AS label_1, e2.label AS label_2,
       coalesce(f.query_key, h.query_key) = coalesce(f.base_key, h.base_key) AS same_item
FROM full_s f FULL JOIN half_s h ON f.query_key = h.query_key AND f.base_key = h.base_key
JOIN embeddings e1 ON e1.vec_id = coalesce(f.query_key, h.query_key)
JOIN embeddings e2 ON e2.vec_id = coalesce(f.base_key, h.base_key)""",
}
