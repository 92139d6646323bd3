"""Registered queries of the core and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checkpoints import cut
from .functions import html, qajson, robots, splitter, text, urls
from .functions.urls import normal_url
from .operators import chunks, frontier, near_dup, reports, scope
from .operators import records as recs
from .operators.hierarchy import hierarchy
from .plans import export
from .sources import packaging

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def p3_found(spark, d):
    created = F.col("created_at")
    tree = hierarchy(table(spark, d, "frontier"), order=[F.expr("try_to_timestamp(created_at)"), created], key=normal_url)
    return tree.select(F.col("node").alias("url"), F.col("root").alias("root_url"), F.col("depth").alias("tree_depth"), "descendants", "cycle_state")


@query
def p3_paths(spark, d):
    created = F.col("created_at")
    tree = hierarchy(table(spark, d, "frontier"), order=[F.expr("try_to_timestamp(created_at)"), created], key=normal_url, with_path=True)
    return tree.select("node", "parent", "root", "depth", "descendants", "cycle_state", F.array_join("path", " > ").alias("path"))


# --- the reference's own operators ----------------------------------------------


def sql(name: str, text: str) -> None:
    SQL[name] = text


_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"


def _url_sql(c: str) -> str:
    t = f"trim({c}, {_BLANKS_SQL})"
    path = f"rtrim(regexp_extract({t}, '^(?i:https?)://[^/?#]*([^?#]*)', 1), '/')"
    query = f"list_sort(list_filter(string_split(regexp_extract({t}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> ''))"
    return (
        f"CASE WHEN regexp_extract({t}, '^(?i:https?)://([^/?#]*)', 1) <> '' THEN lower(regexp_extract({t}, '^((?i:https?)://[^/?#]*)', 1)) || "
        f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END END"
    )


_KEY_SQL = r"rtrim(lower(trim(regexp_replace({}, '[\s\x0b\x{{85}}\x{{a0}}\x1c-\x1f\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))), '.,;:!?')"
_NO_NULL_SQL = "coalesce(question, '')"
_RECS_SQL = "recs AS (SELECT DISTINCT ON (record_id) * FROM canonical)"


def records(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Each canonical record once, redelivered rows differ in loaded_at only; columns are pruned before the rows move."""
    return table(spark, d, "canonical").select("record_id", *columns).dropDuplicates(["record_id"])


@query
def url_normal_forms(spark, d):
    return table(spark, d, "frontier").select("url", normal_url(F.col("url")).alias("normal")).distinct()


sql("url_normal_forms", f"SELECT DISTINCT url, {_url_sql('url')} AS normal FROM frontier")


@query
def url_parts(spark, d):
    u = table(spark, d, "frontier").select(normal_url(F.col("url")).alias("u")).where("u is not null").distinct()
    c = F.col("u")
    return u.select("u", urls.host(c).alias("host"), urls.path(c).alias("path"), urls.section(c).alias("section"), urls.branch(c, "docs.quellimar.example").alias("branch"))


sql("url_parts", rf"""
WITH n AS (SELECT DISTINCT {_url_sql('url')} AS u FROM frontier),
p AS (SELECT u, regexp_extract(u, '://([^/?#]*)', 1) AS host, regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path FROM n WHERE u IS NOT NULL),
s AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg FROM p)
SELECT u, host, path, CASE WHEN len(seg) = 0 THEN 'root' ELSE array_to_string(seg[1:2], '/') END AS section,
  CASE WHEN host <> 'docs.quellimar.example' THEN 'External: ' || host WHEN len(seg) = 0 THEN 'Root Level' ELSE 'Path: /' || seg[1] || '/*' END AS branch
FROM s
""")


@query
def resolved_links(spark, d):
    f = table(spark, d, "frontier").select(F.col("parent_url").alias("base"), F.regexp_replace("url", r"^\s*(?i:https?)://[^/?#]*", "").alias("href")).where("base is not null and href <> ''").distinct()
    return f.select("base", "href", urls.resolve_url(F.col("href"), F.trim("base")).alias("url"))


sql("resolved_links", rf"""
WITH f AS (SELECT DISTINCT parent_url AS base, regexp_replace(url, '^\s*(?i:https?)://[^/?#]*', '') AS href FROM frontier WHERE parent_url IS NOT NULL),
j AS (SELECT base, href, trim(base) AS b, trim(href, {_BLANKS_SQL}) AS h FROM f WHERE href <> ''),
k AS (SELECT base, href, CASE WHEN h = '' THEN NULL ELSE regexp_extract(b, '^(?i:https?)://[^/?#]*') || CASE WHEN starts_with(h, '/') THEN h WHEN starts_with(h, '?') THEN regexp_extract(b, '^(?i:https?)://[^/?#]*([^?#]*)', 1) || h ELSE regexp_extract(b, '^(?i:https?)://[^/?#]*([^#]*)', 1) || h END END AS u FROM j)
SELECT base, href, {_url_sql('u')} AS url FROM k
""")


@query
def branches_of_home(spark, d):
    f = table(spark, d, "frontier").select(normal_url(F.col("url")).alias("u"))
    return scope.branches(f, "u", "docs.quellimar.example").select("category", F.size("urls").alias("urls"), F.col("urls")[0].alias("first_url"))


sql("branches_of_home", rf"""
WITH n AS (SELECT DISTINCT {_url_sql('url')} AS u FROM frontier),
p AS (SELECT u, regexp_extract(u, '://([^/?#]*)', 1) AS host, list_filter(string_split(regexp_extract(u, '://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM n WHERE u IS NOT NULL)
SELECT CASE WHEN host <> 'docs.quellimar.example' THEN 'External: ' || host WHEN len(seg) = 0 THEN 'Root Level' ELSE 'Path: /' || seg[1] || '/*' END AS category,
  count(*)::INT AS urls, min(u) AS first_url FROM p GROUP BY 1
""")


@query
def section_prefixes(spark, d):
    r = table(spark, d, "canonical").select(urls.named_section(F.col("section")).alias("section"), normal_url(F.col("source_url")).alias("u")).where("section is not null").distinct()
    return scope.derive_prefixes(r, "section", "u")


sql("section_prefixes", rf"""
WITH r AS (SELECT DISTINCT trim(lower(section), ' /' || chr(9) || chr(10) || chr(13)) AS section, {_url_sql('source_url')} AS u FROM canonical),
p AS (SELECT section, regexp_extract(u, '://([^/?#]*)', 1) AS host, regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path,
  list_filter(string_split(regexp_extract(u, '://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM r WHERE section NOT IN ('', 'unknown', 'root') AND u IS NOT NULL),
g AS (SELECT section, min(host) AS host, min(seg) AS lo, max(seg) AS hi, min(path) AS p0, max(path) AS p1 FROM p GROUP BY section),
c AS (SELECT section, host, lo[1:(CASE WHEN p0 = p1 THEN greatest(len(lo) - 1, 0) ELSE list_max(list_filter(range(0, len(lo) + 1), lambda i: lo[1:i] = hi[1:i])) END)] AS common FROM g)
SELECT section, host, CASE WHEN len(common) > 0 THEN '/' || array_to_string(common, '/') || '/' END AS prefix, len(common) = 0 AS degenerate FROM c
""")


@query
def scope_decisions(spark, d):
    f = table(spark, d, "frontier").select(normal_url(F.col("url")).alias("u")).where("u is not null").distinct()
    return f.select("u", scope.scope_reason(F.col("u"), F.lit("docs.quellimar.example"), F.lit("/portal/reference/")).alias("reason"))


sql("scope_decisions", rf"""
WITH n AS (SELECT DISTINCT {_url_sql('url')} AS u FROM frontier)
SELECT u, CASE WHEN regexp_extract(u, '://([^/?#]*)', 1) <> 'docs.quellimar.example' THEN 'off_host'
  WHEN NOT starts_with(regexp_extract(u, '://[^/?#]*([^?#]*)', 1) || '/', '/portal/reference/') THEN 'outside_prefix' ELSE 'accepted' END AS reason
FROM n WHERE u IS NOT NULL
""")


@query
def urls_in_any_scope(spark, d):
    f = table(spark, d, "frontier").select(normal_url(F.col("url")).alias("u")).where("u is not null").distinct()
    seeds = table(spark, d, "canonical").select(normal_url(F.col("source_url")).alias("u")).where("u is not null").select(urls.host(F.col("u")).alias("host"), F.concat(F.lit("/"), urls.path_segments(F.col("u"))[0], F.lit("/")).alias("prefix")).distinct()
    inside = scope.in_any_scope(f, "u", seeds)
    return scope.sections(inside, "u", seeds, 1).groupBy("section_label").agg(F.count("*").alias("urls"))


sql("urls_in_any_scope", rf"""
WITH f AS (SELECT DISTINCT {_url_sql('url')} AS u FROM frontier),
c AS (SELECT DISTINCT {_url_sql('source_url')} AS u FROM canonical),
seeds AS (SELECT DISTINCT regexp_extract(u, '://([^/?#]*)', 1) AS host, '/' || regexp_extract(u, '://[^/?#]*/([^/?#]+)', 1) || '/' AS prefix FROM c WHERE u IS NOT NULL),
k AS (SELECT u, regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path, s.prefix FROM f JOIN seeds s ON regexp_extract(u, '://([^/?#]*)', 1) = s.host AND starts_with(regexp_extract(u, '://[^/?#]*([^?#]*)', 1) || '/', s.prefix)),
l AS (SELECT u, list_filter(string_split(substr(path, length(max(prefix)) + 1), '/'), lambda x: x <> '') AS seg FROM k GROUP BY u, path)
SELECT CASE WHEN len(seg) = 0 THEN 'root' ELSE seg[1] END AS section_label, count(*) AS urls FROM l GROUP BY 1
""")


@query
def merged_chunks(spark, d):
    c = table(spark, d, "chunks").withColumn("page", normal_url(F.col("source_url")))
    return chunks.merge_chunks(c, "text", "page", "parent_text", [F.col("chunk_no")]).select("chunk_id", "text", F.array_join("sources", " ").alias("sources"), F.md5("parent_text").alias("parent_md5"))


sql("merged_chunks", rf"""
WITH r AS (SELECT sha256({_KEY_SQL.format('text')}) AS chunk_id, chunk_no, text, {_url_sql('source_url')} AS page, parent_text FROM chunks WHERE text IS NOT NULL),
p AS (SELECT chunk_id, page, min(chunk_no) AS n FROM r GROUP BY 1, 2),
s AS (SELECT chunk_id, array_to_string(list(page ORDER BY n) FILTER (WHERE page IS NOT NULL), ' ') AS sources, min(n) AS n FROM p GROUP BY 1)
SELECT s.chunk_id, r.text, coalesce(s.sources, '') AS sources, md5(r.parent_text) AS parent_md5 FROM s JOIN r ON r.chunk_no = s.n AND r.chunk_id = s.chunk_id
""")


@query
def upserted_chunks(spark, d):
    c = table(spark, d, "chunks").withColumn("page", normal_url(F.col("source_url")))
    parts = [chunks.merge_chunks(c.where(F.col("embedding_model").isNotNull() if k == 0 else F.lit(True)), "text", "page", "parent_text", [F.col("chunk_no")]) for k in (0, 1)]
    return chunks.upsert_chunks(parts[0], parts[1]).select("chunk_id", F.size("sources").alias("n_sources"))


sql("upserted_chunks", rf"SELECT sha256({_KEY_SQL.format('text')}) AS chunk_id, count(DISTINCT {_url_sql('source_url')})::INT AS n_sources FROM chunks WHERE text IS NOT NULL GROUP BY 1")


@query
def nearest_vectors(spark, d):
    e = table(spark, d, "embeddings")
    return chunks.nearest_to_all(e, e.where("vec_id % 100 = 0"), 5).select("query_id", "vec_id", F.round("distance", 5).alias("distance"), F.col("rank").cast("long").alias("rank"))


sql("nearest_vectors", """
WITH q AS (SELECT vec_id AS query_id, embedding AS a FROM embeddings WHERE vec_id % 100 = 0),
p AS (SELECT query_id, vec_id, list_sum(list_transform(range(1, len(a) + 1), lambda i: (a[i]::DOUBLE - embedding[i]::DOUBLE) * (a[i]::DOUBLE - embedding[i]::DOUBLE))) AS dist FROM q, embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS rank FROM p)
SELECT query_id, vec_id, round(dist, 5) AS distance, rank FROM r WHERE rank <= 5
""")


def _intent(spark, d) -> list[float]:
    return list(table(spark, d, "embeddings").where("vec_id is not null").orderBy("vec_id").select("embedding").first()[0])


@query
def top_units_by_label(spark, d):
    e = table(spark, d, "embeddings")
    return chunks.top_units(e, "label", "embedding", _intent(spark, d), 3, "vec_id").select("label", "vec_id", F.round("score", 6).alias("score"), F.col("chunk_index").cast("long").alias("chunk_index"))


_COS_SQL = """
WITH i AS (SELECT embedding AS b FROM embeddings WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT 1),
s AS (SELECT label, vec_id, list_sum(list_transform(range(1, len(b) + 1), lambda k: embedding[k]::DOUBLE * b[k]::DOUBLE))
  / (sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(b, lambda x: x::DOUBLE * x::DOUBLE)))) AS score FROM embeddings, i)
"""
sql("top_units_by_label", _COS_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) - 1 AS chunk_index FROM s) SELECT label, vec_id, round(score, 6) AS score, chunk_index FROM r WHERE chunk_index < 3")


@query
def page_relevance(spark, d):
    return chunks.page_scores(table(spark, d, "embeddings"), "label", "embedding", _intent(spark, d)).select("label", F.round("score", 6).alias("score"), (F.col("score") >= 0.5).alias("extracted"))


sql("page_relevance", _COS_SQL + "SELECT label, round(max(score), 6) AS score, max(score) >= 0.5 AS extracted FROM s GROUP BY label")


@query
def rejected_records(spark, d):
    return recs.with_reasons(records(spark, d, "question", "answer")).where("_reject_reason is not null").select("record_id", F.col("_reject_reason").alias("reason"))


_STRIP_SQL = "trim(coalesce({}, ''), " + _BLANKS_SQL + ")"
_REASON_SQL = f"CASE WHEN {_STRIP_SQL.format('answer')} = '' THEN 'empty_answer' WHEN lower({_STRIP_SQL.format('question')}) = lower({_STRIP_SQL.format('answer')}) THEN 'question_equals_answer' WHEN length({_STRIP_SQL.format('answer')}) < 20 THEN 'answer_too_short' END"
sql("rejected_records", f"WITH {_RECS_SQL} SELECT record_id, {_REASON_SQL} AS reason FROM recs WHERE {_REASON_SQL} IS NOT NULL")


@query
def first_by_question(spark, d):
    return recs.dedup_by_question(records(spark, d, "question"), [F.col("record_id")]).select("record_id")


sql("first_by_question", f"WITH {_RECS_SQL} SELECT min(record_id) AS record_id FROM recs GROUP BY {_KEY_SQL.format(_NO_NULL_SQL)}")


@query
def raw_texts(spark, d):
    return recs.to_raw_text(records(spark, d, "source_chunk"), [F.col("record_id")]).select(F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


sql("raw_texts", f"WITH {_RECS_SQL}, k AS (SELECT arg_min(source_chunk, record_id) AS t FROM recs WHERE source_chunk <> '' GROUP BY {_KEY_SQL.format('source_chunk')}) SELECT md5(t) AS text_md5, length(t)::INT AS chars FROM k")


@query
def hash_splits(spark, d):
    return recs.hash_split(records(spark, d, "source_url").withColumn("page", normal_url(F.col("source_url"))), "page").select("record_id", "split")


sql("hash_splits", f"""
WITH {_RECS_SQL}, h AS (SELECT record_id, ('0x' || substr(sha256('42' || chr(1) || coalesce(nullif({_url_sql('source_url')}, ''), 'unknown')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM recs)
SELECT record_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM h
""")


@query
def seeded_splits(spark, d):
    return recs.split_records(records(spark, d, "source_url").withColumn("page", normal_url(F.col("source_url"))), "page").select("record_id", "split")


@query
def projected_alpaca(spark, d):
    return recs.project(records(spark, d, "question", "answer"), "alpaca")


sql("projected_alpaca", f"WITH {_RECS_SQL} SELECT question AS instruction, '' AS input, answer AS output FROM recs")


@query
def projected_completions(spark, d):
    return recs.project(records(spark, d, "question", "answer"), "prompt_completion")


sql("projected_completions", f"WITH {_RECS_SQL} SELECT question AS prompt, answer AS completion FROM recs")


@query
def projected_embedding_pairs(spark, d):
    return recs.project(records(spark, d, "question", "source_chunk"), "embedding_pairs")


sql("projected_embedding_pairs", f"WITH {_RECS_SQL} SELECT question AS anchor, source_chunk AS positive FROM recs")


@query
def projected_rag_eval(spark, d):
    return recs.project(records(spark, d, "question", "answer", "source_chunk"), "rag_eval")


sql("projected_rag_eval", f"WITH {_RECS_SQL} SELECT question, answer AS ground_truth_answer, source_chunk AS context FROM recs")


@query
def projected_chats(spark, d):
    m = recs.project(records(spark, d, "question", "answer"), "conversational")
    return m.select(F.array_join(F.transform("messages", lambda x: F.concat_ws(": ", x["role"], F.coalesce(x["content"], F.lit("")))), "\n").alias("chat"))


sql("projected_chats", f"WITH {_RECS_SQL} SELECT 'user: ' || coalesce(question, '') || chr(10) || 'assistant: ' || coalesce(answer, '') AS chat FROM recs")


@query
def projected_vertex(spark, d):
    m = recs.project(records(spark, d, "question", "answer"), "vertex")
    return m.select(F.col("contents")[0]["role"].alias("first_role"), F.col("contents")[0]["parts"][0]["text"].alias("first_text"), F.col("contents")[1]["role"].alias("second_role"), F.col("contents")[1]["parts"][0]["text"].alias("second_text"))


sql("projected_vertex", f"WITH {_RECS_SQL} SELECT 'user' AS first_role, question AS first_text, 'model' AS second_role, answer AS second_text FROM recs")


@query
def mined_triplets(spark, d):
    r = records(spark, d, "question", "source_chunk", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    return recs.mine_triplets(r, [F.col("record_id")]).select("anchor", F.md5("positive").alias("positive_md5"), F.md5("negative").alias("negative_md5"))


@query
def near_duplicate_answers(spark, d):
    r = records(spark, d, "answer", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    _, pairs = near_dup.near_classes(r, "answer", near_dup.ANSWER_THRESHOLD, "record_id")
    return pairs.select("a", "b", F.round("forward", 6).alias("forward"), F.round("backward", 6).alias("backward"))


@query
def near_duplicate_answer_links(spark, d):
    r = records(spark, d, "answer", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    members, pairs = near_dup.near_classes(r, "answer", near_dup.ANSWER_THRESHOLD, "record_id")
    return near_dup.near_links(members, cut(pairs)).select(F.col("s").alias("record_id"), F.col("cls").alias("class_first"), "links")


@query
def near_duplicate_questions(spark, d):
    r = records(spark, d, "question", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    _, pairs = near_dup.near_classes(r, "question", near_dup.QUESTION_THRESHOLD, "record_id")
    return pairs.select("a", "b", F.round("forward", 6).alias("forward"), F.round("backward", 6).alias("backward"))


@query
def near_duplicate_question_links(spark, d):
    r = records(spark, d, "question", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    members, pairs = near_dup.near_classes(r, "question", near_dup.QUESTION_THRESHOLD, "record_id")
    return near_dup.near_links(members, cut(pairs)).select(F.col("s").alias("record_id"), F.col("cls").alias("class_first"), "links")


@query
def duplicate_answer_classes(spark, d):
    r = records(spark, d, "answer", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    return near_dup.duplicate_classes(r, "answer", "record_id")


sql("duplicate_answer_classes", f"""
WITH {_RECS_SQL}, k AS (SELECT record_id, coalesce({_url_sql('source_url')}, '') AS g, regexp_replace(lower(coalesce(answer, '')), '[^a-z0-9 ]', '', 'g') AS t FROM recs)
SELECT record_id, min(record_id) OVER (PARTITION BY g, t) AS class_first FROM k
""")


@query
def near_deduplicated(spark, d):
    r = records(spark, d, "answer", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    _, reasons = near_dup.semantic_dedup(r, "answer", 0.8, "record_id")
    return reasons


@query
def redundancy_causes(spark, d):
    r = records(spark, d, "answer", "source_url", "source_chunk", "chunk_index").withColumn("source_url", normal_url(F.col("source_url")))
    members, pairs = near_dup.near_classes(r, "answer", near_dup.ANSWER_THRESHOLD, "record_id")
    return reports.redundancy_of_classes(r, members, cut(pairs), "record_id")


@query
def pairs_per_page(spark, d):
    return reports.pairs_per_page(records(spark, d, "source_url").withColumn("source_url", normal_url(F.col("source_url"))))


sql("pairs_per_page", f"WITH {_RECS_SQL} SELECT coalesce({_url_sql('source_url')}, '') AS source_url, count(*) AS pairs FROM recs GROUP BY 1")


@query
def dataset_counts(spark, d):
    r = records(spark, d, "question", "source_url").withColumn("source_url", normal_url(F.col("source_url")))
    pages = reports.pairs_per_page(r).agg(F.count("*").alias("pages"), F.sum("pairs").alias("total"), F.min("pairs").alias("least"), F.max("pairs").alias("most"), F.round(F.avg("pairs"), 6).alias("mean"))
    return pages.crossJoin(r.agg((F.count("*") - F.countDistinct(text.chunk_key(F.coalesce("question", F.lit(""))))).alias("exact_duplicates")))


sql("dataset_counts", f"""
WITH {_RECS_SQL}, p AS (SELECT coalesce({_url_sql('source_url')}, '') AS u, count(*) AS n FROM recs GROUP BY 1)
SELECT count(*) AS pages, sum(n)::BIGINT AS total, min(n) AS least, max(n) AS most, round(avg(n), 6) AS mean,
  (SELECT count(*) - count(DISTINCT {_KEY_SQL.format("coalesce(question, '')")}) FROM recs) AS exact_duplicates FROM p
""")


@query
def score_statistics(spark, d):
    s = reports.score_stats(table(spark, d, "frontier"))
    return s.select("n", *[F.round(c, 6).alias(c) for c in ("lo", "hi", "mean", "median", "stdev")])


sql("score_statistics", "SELECT count(*) AS n, round(min(relevance_score), 6) AS lo, round(max(relevance_score), 6) AS hi, round(avg(relevance_score), 6) AS mean, round(median(relevance_score), 6) AS median, round(stddev_pop(relevance_score), 6) AS stdev FROM frontier WHERE relevance_score IS NOT NULL")


@query
def score_thresholds(spark, d):
    return reports.threshold_sweep(table(spark, d, "frontier")).withColumn("threshold", F.round("threshold", 1))


sql("score_thresholds", "WITH s AS (SELECT relevance_score AS v FROM frontier WHERE relevance_score IS NOT NULL) SELECT t / 10.0::DOUBLE AS threshold, count(*) FILTER (WHERE v < t / 10.0::DOUBLE) AS skipped, count(*) AS total FROM s, range(1, 10) r(t) GROUP BY t")


@query
def scored_pages_with_pairs(spark, d):
    f = frontier.scores(_front(spark, d))
    r = table(spark, d, "canonical").select("record_id", normal_url(F.col("source_url")).alias("source_url")).distinct()
    return reports.scores_with_pairs(f, r).select("url", "relevance_score", "status", "pairs")


_FRONT_SQL = f"front AS (SELECT url, arg_min(struct_pack(host := host, depth := depth, parent_url := parent_url, status := status, score := score, tries := tries, nb := nb, created := created), created) AS r FROM (SELECT {_url_sql('url')} AS url, host, depth, {_url_sql('parent_url')} AS parent_url, status, relevance_score AS score, retry_count AS tries, not_before AS nb, created_at AS created FROM frontier) WHERE url IS NOT NULL GROUP BY url)"
sql("scored_pages_with_pairs", f"""
WITH {_FRONT_SQL}, {_RECS_SQL}, p AS (SELECT {_url_sql('source_url')} AS u, count(*) AS n FROM recs GROUP BY 1)
SELECT url, r.score AS relevance_score, r.status AS status, coalesce(n, 0) AS pairs FROM front LEFT JOIN p ON u = url WHERE r.score IS NOT NULL
""")


def _front(spark, d) -> DataFrame:
    """The frontier with one row per normal url, the earliest."""
    f = table(spark, d, "frontier").withColumn("url", normal_url(F.col("url"))).withColumn("parent_url", normal_url(F.col("parent_url"))).where("url is not null")
    rest = [c for c in f.columns if c != "url"]
    return f.groupBy("url").agg(F.min_by(F.struct(*rest), "created_at").alias("r")).select("url", "r.*")


@query
def frontier_status_counts(spark, d):
    return frontier.counts(_front(spark, d))


sql("frontier_status_counts", f"WITH {_FRONT_SQL} SELECT r.status AS status, count(*) AS n FROM front GROUP BY 1")
_NOON = "2025-03-01T12:00:00.000000+00:00"


@query
def frontier_claims(spark, d):
    return frontier.claimable(_front(spark, d), F.lit(_NOON), 40).select("url", "created_at")


sql("frontier_claims", f"WITH {_FRONT_SQL} SELECT url, r.created AS created_at FROM front WHERE r.status = 'queued' AND (r.nb IS NULL OR r.nb::TIMESTAMPTZ <= TIMESTAMPTZ '2025-03-01 12:00:00+00') ORDER BY r.created, url LIMIT 40")


@query
def frontier_after_recovery(spark, d):
    out = frontier.recover(_front(spark, d), F.lit(_NOON))
    return out.select("url", "status", "retry_count")


sql("frontier_after_recovery", f"""
WITH {_FRONT_SQL}, m AS (SELECT url, r.parent_url AS parent_url, r.score AS score, r.status = 'in_progress' AS hit,
  CASE WHEN r.status = 'in_progress' THEN CASE WHEN r.tries + 1 >= 3 THEN 'failed' ELSE 'queued' END ELSE r.status END AS status,
  (CASE WHEN r.status = 'in_progress' THEN r.tries + 1 ELSE r.tries END)::INT AS retry_count FROM front),
rel AS (SELECT url, CASE WHEN status <> 'failed' AND score >= 0 THEN 'queued' ELSE 'skipped_follow' END AS child FROM m WHERE hit AND (status = 'failed' OR score IS NOT NULL))
SELECT m.url, CASE WHEN m.status = 'pending_score' AND rel.child IS NOT NULL THEN rel.child ELSE m.status END AS status, m.retry_count FROM m LEFT JOIN rel ON rel.url = m.parent_url
""")


@query
def frontier_after_scores(spark, d):
    f = _front(spark, d)
    o = f.where("status = 'done' and relevance_score is not null").select("url", F.when(F.col("relevance_score") < 0.5, "skipped_extract").otherwise("done").alias("outcome"), F.col("relevance_score").alias("score"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("not_before"))
    return frontier.counts(frontier.resolve(f, o, F.lit(_NOON), 0.55))


sql("frontier_after_scores", f"""
WITH {_FRONT_SQL}, m AS (SELECT url, r.parent_url AS parent_url, r.score AS score, r.status = 'done' AND r.score IS NOT NULL AS hit,
  CASE WHEN r.status = 'done' AND r.score < 0.5 THEN 'skipped_extract' ELSE r.status END AS status FROM front),
rel AS (SELECT url, CASE WHEN score >= 0.55 THEN 'queued' ELSE 'skipped_follow' END AS child FROM m WHERE hit)
SELECT CASE WHEN m.status = 'pending_score' AND rel.child IS NOT NULL THEN rel.child ELSE m.status END AS status, count(*) AS n FROM m LEFT JOIN rel ON rel.url = m.parent_url GROUP BY 1
""")


@query
def frontier_new_children(spark, d):
    f = _front(spark, d)
    links = table(spark, d, "documents").select(normal_url(F.col("url")).alias("parent_url"), F.concat(normal_url(F.col("url")), F.lit("/more")).alias("url"), F.lit(1).alias("parent_depth"), F.lit("more").alias("section_label"))
    return frontier.insert_children(f, links, F.lit(_NOON), 3).where(F.col("section_label") == "more").select("url", "parent_url", "depth", "status")


sql("frontier_new_children", f"WITH n AS (SELECT DISTINCT {_url_sql('url')} AS parent_url FROM documents) SELECT parent_url || '/more' AS url, parent_url, 2 AS depth, 'pending_score' AS status FROM n WHERE parent_url IS NOT NULL")


@query
def frontier_quiescence(spark, d):
    return frontier.quiescent(_front(spark, d))


sql("frontier_quiescence", f"""
WITH {_FRONT_SQL} SELECT (SELECT count(*) FROM front WHERE r.status IN ('queued', 'in_progress')) AS open,
  (SELECT count(*) FROM front c LEFT JOIN front p ON p.url = c.r.parent_url WHERE c.r.status = 'pending_score' AND (p.url IS NULL OR p.r.status IN ('done', 'skipped_extract', 'skipped_follow', 'failed'))) AS stray,
  (SELECT count(*) FROM front WHERE r.status IN ('queued', 'in_progress')) = 0 AS over
""")


@query
def frontier_seeded(spark, d):
    c = table(spark, d, "canonical").select(normal_url(F.col("source_url")).alias("url")).distinct()
    f = frontier.seed(_front(spark, d).where("depth > 0"), c.unionByName(table(spark, d, "frontier").where("depth = 0").select(normal_url(F.col("url")).alias("url"))), F.lit(_NOON))
    return f.groupBy("depth", "status").agg(F.count("*").alias("n"))


sql("frontier_seeded", f"""
WITH {_FRONT_SQL}, kept AS (SELECT url, r.depth AS depth, r.status AS status FROM front WHERE r.depth > 0),
s AS (SELECT DISTINCT url FROM (SELECT {_url_sql('source_url')} AS url FROM canonical UNION ALL SELECT {_url_sql('url')} FROM frontier WHERE depth = 0) WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM kept))
SELECT depth, status, count(*) AS n FROM (SELECT depth, status FROM kept UNION ALL SELECT 0, 'queued' FROM s) GROUP BY 1, 2
""")


@query
def polite_starts(spark, d):
    p = table(spark, d, "host_policies").select("host", "crawl_delay")
    f = _front(spark, d).select("url", urls.host(F.col("url")).alias("host"), F.unix_micros(F.try_to_timestamp("created_at")).alias("us")).join(p, "host", "left")
    s = frontier.start_times(f.withColumn("arrival", F.col("us") / F.lit(1e6)), "host", "arrival", "url", F.coalesce("crawl_delay", F.lit(0.5)))
    return s.groupBy("host").agg(F.count("*").alias("requests"), F.round(F.max(F.col("start") - F.col("arrival")), 3).alias("longest_wait"))


sql("polite_starts", f"""
WITH {_FRONT_SQL}, a AS (SELECT url, regexp_extract(url, '://([^/?#]*)', 1) AS host, epoch_us(r.created::TIMESTAMPTZ) / 1000000.0::DOUBLE AS arrival FROM front),
j AS (SELECT a.*, coalesce(p.crawl_delay, 0.5) AS delay, row_number() OVER (PARTITION BY a.host ORDER BY arrival, url) - 1 AS k FROM a LEFT JOIN host_policies p ON p.host = a.host),
s AS (SELECT *, max(arrival - delay * k) OVER (PARTITION BY host ORDER BY arrival, url ROWS UNBOUNDED PRECEDING) + delay * k AS start FROM j)
SELECT host, count(*) AS requests, round(max(start - arrival), 3) AS longest_wait FROM s GROUP BY host
""")


@query
def robots_decisions(spark, d):
    lines = F.concat_ws("\n", F.lit("User-agent: *"), F.when(F.col("disallows_root_for_star"), "Disallow: /"), F.lit("Allow: /*/reference/"), F.lit("Disallow: /*?*v="), F.when(F.col("crawl_delay").isNotNull(), F.concat(F.lit("Crawl-delay: "), F.col("crawl_delay"))))
    p = table(spark, d, "host_policies").where("robots_found").withColumn("p", robots.policy(lines)).select("host", "p.rules")
    f = _front(spark, d).select("url").withColumn("host", urls.host(F.col("url"))).join(p, "host", "left")
    return f.select("url", F.when(F.col("rules").isNull(), True).otherwise(robots.allowed(F.col("url"), F.col("rules"))).alias("allowed"))


sql("robots_decisions", f"""
WITH {_FRONT_SQL}, a AS (SELECT url, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS target FROM front)
SELECT url, CASE WHEN NOT coalesce(robots_found, false) THEN true WHEN regexp_matches(target, '^/.*/reference/') THEN true
  WHEN regexp_matches(target, '^/.*\\?.*v=') THEN false ELSE NOT coalesce(disallows_root_for_star, false) END AS allowed
FROM a LEFT JOIN host_policies p ON p.host = a.host
""")


@query
def parsed_pairs(spark, d):
    body = F.to_json(F.array(F.struct(F.col("question").alias("instruction"), F.col("answer").alias("response"))), {"ignoreNullFields": "false"})
    form = F.pmod(F.col("record_id"), F.lit(4))
    r = records(spark, d, "question", "answer").withColumn("said", F.when(form == 0, body).when(form == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(form == 2, F.concat(F.lit("Here they are: "), body, F.lit(" Done."))).otherwise(F.lit("no list here")))
    p = r.withColumn("p", qajson.parse_pairs(F.col("said")))
    return p.select("record_id", F.col("p").isNull().alias("malformed"), F.get(F.col("p"), F.lit(0))["instruction"].alias("instruction"), F.get(F.col("p"), F.lit(0))["response"].alias("response"))


sql("parsed_pairs", f"WITH {_RECS_SQL} SELECT record_id, record_id % 4 = 3 AS malformed, CASE WHEN record_id % 4 < 3 THEN question END AS instruction, CASE WHEN record_id % 4 < 3 THEN answer END AS response FROM recs")


@query
def text_signals(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.page_title(t).alias("title"), text.licence_signal(t).alias("licence"), F.md5(text.headings(t)).alias("headings_md5"), text.chunk_id(t).alias("chunk_id"), F.length(text.near_key(t)).alias("near_chars"))


sql("text_signals", rf"""
SELECT doc_id, nullif(trim(regexp_replace(regexp_extract(text, '(?m)^#\s+(.+)$', 1), '\[.*?\]\(.*?\)', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)), '') AS title,
  coalesce(nullif(trim(regexp_extract(text, '(?i)creative commons(?:\s+attribution)?(?:[\s-]+\S+){{0,4}}')), ''), nullif(trim(regexp_extract(text, '(?i)CC[\s-]BY(?:-[A-Z]+)*(?:\s+\d(?:\.\d)?)?')), ''),
    nullif(trim(regexp_extract(text, '(?i)MIT license')), ''), nullif(trim(regexp_extract(text, '(?i)apache license(?:,?\s+version\s+[\d.]+)?')), ''),
    nullif(trim(regexp_extract(text, '(?i)all rights reserved')), ''), nullif(trim(regexp_extract(text, '©\s*\d{{4}}[^\n]{{0,80}}')), '')) AS licence,
  md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: starts_with(x, '#')), chr(10))) AS headings_md5,
  sha256({_KEY_SQL.format('text')}) AS chunk_id, length(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9 ]', '', 'g'))::INT AS near_chars FROM documents
""")


@query
def clean_texts(spark, d):
    out = text.without_chrome_lines(text.unlinked(F.col("text")))
    return table(spark, d, "documents").select("doc_id", F.md5(out).alias("text_md5"), F.length(out).alias("chars"))


_TARGET_SQL = r'[^)\s]+(?:\s+"[^"]*")?'
_INNER_SQL = r"(?:[^\[\]]|\[[^\[\]]*\])*"
# images step aside under control characters while links become their text
sql("clean_texts", rf"""
WITH a AS (SELECT doc_id, regexp_replace(text, '!\[({_INNER_SQL})\]\(({_TARGET_SQL})\)', chr(2) || '\1' || chr(3) || '\2' || chr(4), 'g') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\[[\s`]*(?i:{"|".join(re.sub(r"([!-/:-@\[-`{-~])", r"\\\1", w) for w in text.GENERIC_LINKS).replace("'", "''")})[\s`]*\]\({_TARGET_SQL}\)', '', 'g'), '\[(?:[^\[\]A-Za-z0-9]|\[[^\[\]A-Za-z0-9]*\])*\]\({_TARGET_SQL}\)', '', 'g') AS t FROM a),
c AS (SELECT doc_id, replace(replace(replace(regexp_replace(t, '\[({_INNER_SQL})\]\({_TARGET_SQL}\)', '\1', 'g'), chr(2), '!['), chr(3), ']('), chr(4), ')') AS t FROM b),
e AS (SELECT doc_id, array_to_string(list_filter(string_split(t, chr(10)), lambda x: trim(regexp_replace(lower(trim(x, ' ' || chr(9) || chr(13))), '^```\w*\s*', ''), ' ' || chr(9) || chr(13)) NOT IN ({", ".join("'" + p.lower().replace("'", "''") + "'" for p in text.CHROME_LINES)})), chr(10)) AS t FROM c)
SELECT doc_id, md5(t) AS text_md5, length(t)::INT AS chars FROM e
""")


@query
def text_chunks(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.explode(splitter.chunks(F.col("text"), 2000, 200)).alias("chunk"))
    return t.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.max(F.length("chunk")).alias("longest"))


@query
def parent_child_chunks(spark, d):
    t = splitter.parent_child(table(spark, d, "documents").select("doc_id", "text"), "text")
    return t.select("doc_id", "parent_no", "child_no", text.chunk_id(F.col("chunk")).alias("chunk_id"))


@query
def read_pages(spark, d):
    """Pages made of the documents' lines, with chrome around, hidden parts and open tags between them, read back."""
    bare = lambda x: F.btrim(F.regexp_replace(x, r"[^\p{L}\p{N}.,:;!?-]+", " "))
    block = lambda x: F.when(bare(x) == "", "<div hidden>gone <b>too</b></div>").when(x.startswith("#"), F.concat(F.lit("<h2 class=t>"), bare(x), F.lit("</h2>"))).otherwise(F.concat(F.lit("<p> "), bare(x), F.lit("\n<button>Copy</button>")))
    body = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), block), "\n")
    whole = F.concat(F.lit("<html><head><style>p{}</style></head><nav><a href='/a'>Nav</a></nav><main>"), body, F.lit("<aside><p>Aside</aside><div role=complementary>x</div><a href='/b'>next</a></main><footer>F</footer><script>if (a < b) {}</script></html>"))
    p = table(spark, d, "documents").select("doc_id", html.page(whole).alias("p"))
    return p.select("doc_id", F.md5("p.markdown").alias("markdown_md5"), F.array_join("p.hrefs", " ").alias("hrefs"))


sql("read_pages", rf"""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: CASE WHEN starts_with(x, '#') THEN '## ' ELSE '' END || trim(regexp_replace(x, '[^\p{{L}}\p{{N}}.,:;!?-]+', ' ', 'g'))), lambda x: x NOT IN ('', '## ')) AS b FROM documents),
k AS (SELECT doc_id, array_to_string(list_append(b, 'next'), chr(10) || chr(10)) AS md FROM l)
SELECT doc_id, md5(array_to_string(list_filter(string_split(md, chr(10)), lambda x: lower(trim(x)) NOT IN ({", ".join("'" + p.lower().replace("'", "''") + "'" for p in text.CHROME_LINES)})), chr(10))) AS markdown_md5, '/a /b' AS hrefs FROM k
""")


@query
def section_slugs(spark, d):
    return text.slugs(table(spark, d, "canonical").select("section"), "section")


sql("section_slugs", r"""
WITH l AS (SELECT DISTINCT section FROM canonical WHERE section IS NOT NULL),
b AS (SELECT section, regexp_replace(regexp_replace(lower(section), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s0 FROM l),
c AS (SELECT section, CASE WHEN s0 = '' THEN 'root' ELSE s0 END AS s1 FROM b),
n AS (SELECT section, s1, row_number() OVER (PARTITION BY s1 ORDER BY section) - 1 AS n FROM c),
k AS (SELECT section, n, CASE WHEN n = 0 THEN s1 ELSE s1 || '-' || n END AS cand FROM n)
SELECT k.section, CASE WHEN k.n > 0 AND o.cand IS NOT NULL THEN k.cand || '-' || substr(sha256(k.section), 1, 8) ELSE k.cand END AS slug
FROM k LEFT JOIN (SELECT cand FROM k WHERE n = 0) o ON o.cand = k.cand
""")


@query
def section_manifest(spark, d):
    r = records(spark, d, "section", "source_url").withColumn("source_url", normal_url(F.col("source_url"))).withColumn("section", urls.named_section(F.col("section")))
    return packaging.manifest(r)


sql("section_manifest", rf"""
WITH {_RECS_SQL}, r AS (SELECT coalesce(CASE WHEN s NOT IN ('', 'unknown', 'root') THEN s END, 'root') AS section, u FROM (SELECT trim(lower(section), ' /' || chr(9) || chr(10) || chr(13)) AS s, {_url_sql('source_url')} AS u FROM recs)),
p AS (SELECT DISTINCT section, regexp_extract(u, '://([^/?#]*)', 1) AS host, regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path,
  list_filter(string_split(regexp_extract(u, '://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM r WHERE u IS NOT NULL),
g AS (SELECT section, min(host) AS host, min(seg) AS lo, max(seg) AS hi, min(path) AS p0, max(path) AS p1 FROM p GROUP BY section),
c AS (SELECT section, host, lo[1:(CASE WHEN p0 = p1 THEN greatest(len(lo) - 1, 0) ELSE list_max(list_filter(range(0, len(lo) + 1), lambda i: lo[1:i] = hi[1:i])) END)] AS common FROM g),
l AS (SELECT section, count(*) AS row_count FROM r GROUP BY section),
b AS (SELECT section, row_count, regexp_replace(regexp_replace(lower(section), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s0 FROM l),
n AS (SELECT section, row_count, CASE WHEN s0 = '' THEN 'root' ELSE s0 END AS s1, row_number() OVER (PARTITION BY CASE WHEN s0 = '' THEN 'root' ELSE s0 END ORDER BY section) - 1 AS n FROM b),
k AS (SELECT section, row_count, n, CASE WHEN n = 0 THEN s1 ELSE s1 || '-' || n END AS cand FROM n)
SELECT k.section, k.row_count, 'https://' || c.host || CASE WHEN len(c.common) > 0 THEN '/' || array_to_string(c.common, '/') || '/' ELSE '/' END AS url_prefix,
  CASE WHEN k.n > 0 AND o.cand IS NOT NULL THEN k.cand || '-' || substr(sha256(k.section), 1, 8) ELSE k.cand END AS slug
FROM k LEFT JOIN c ON c.section = k.section LEFT JOIN (SELECT cand FROM k WHERE n = 0) o ON o.cand = k.cand
""")


@query
def card_of_records(spark, d):
    c = export.dataset_card(records(spark, d, "source_url", "crawl_date", "license_signal"), 0, 0, 0)
    return c.select(F.array_join("sites", " ").alias("sites"), F.array_join("crawl_dates", " ").alias("crawl_dates"), F.array_join("license_signals_observed", "|").alias("licences"))


sql("card_of_records", f"""
WITH {_RECS_SQL} SELECT (SELECT array_to_string(list(s ORDER BY s), ' ') FROM (SELECT DISTINCT regexp_extract(source_url, '^[^/]*//([^/]*)', 1) AS s FROM recs) WHERE s <> '') AS sites,
  (SELECT array_to_string(list(s ORDER BY s), ' ') FROM (SELECT DISTINCT crawl_date AS s FROM recs) WHERE s <> '') AS crawl_dates,
  (SELECT array_to_string(list(s ORDER BY s), '|') FROM (SELECT DISTINCT license_signal AS s FROM recs) WHERE s <> '') AS licences
""")


@query
def exported_rows(spark, d):
    r = records(spark, d, "question", "answer", "source_url").withColumn("page", normal_url(F.col("source_url")))
    valid, _ = recs.validate(r)
    kept = recs.hash_split(recs.dedup_by_question(valid, [F.col("record_id")]), "page")
    return kept.select("record_id", "split", F.col("question").alias("prompt"), F.col("answer").alias("completion"))


sql("exported_rows", f"""
WITH {_RECS_SQL}, v AS (SELECT * FROM recs WHERE {_REASON_SQL} IS NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL.format("coalesce(question, '')")} ORDER BY record_id) AS rn FROM v),
h AS (SELECT *, ('0x' || substr(sha256('42' || chr(1) || coalesce(nullif({_url_sql('source_url')}, ''), 'unknown')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM k WHERE rn = 1)
SELECT record_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split, question AS prompt, answer AS completion FROM h
""")

_TREE_SQL = rf"""
WITH RECURSIVE n AS (SELECT {_url_sql('url')} AS url, nullif({_url_sql('parent_url')}, '') AS p, created_at FROM frontier),
node AS (SELECT url, arg_min(coalesce(p, ''), created_at) AS p FROM n WHERE url IS NOT NULL GROUP BY url),
link AS (SELECT a.url, b.url AS parent, nullif(a.p, '') AS p FROM node a LEFT JOIN node b ON b.url = a.p),
reach(url, anc) AS (SELECT url, parent FROM link WHERE parent IS NOT NULL UNION SELECT r.url, l.parent FROM reach r JOIN link l ON l.url = r.anc WHERE l.parent IS NOT NULL),
member AS (SELECT DISTINCT url FROM reach WHERE url = anc),
low AS (SELECT r.url, min(r.anc) AS ring FROM reach r JOIN member m ON m.url = r.anc GROUP BY r.url),
level AS (SELECT l.url, count(r.anc) AS depth, max(CASE WHEN up.parent IS NULL THEN r.anc END) AS top FROM link l LEFT JOIN reach r ON r.url = l.url LEFT JOIN link up ON up.url = r.anc GROUP BY l.url),
down AS (SELECT anc AS url, count(*) AS k FROM reach WHERE url <> anc GROUP BY anc),
tree AS (SELECT t.url, l.p, coalesce(o.ring, v.top, t.url) AS root, CASE WHEN o.ring IS NULL THEN v.depth::BIGINT ELSE -1 END AS depth, coalesce(d.k, 0) AS descendants,
  CASE WHEN m.url IS NOT NULL THEN 'member' WHEN o.ring IS NOT NULL THEN 'below' ELSE 'none' END AS cycle_state
FROM node t JOIN link l ON l.url = t.url JOIN level v ON v.url = t.url LEFT JOIN low o ON o.url = t.url LEFT JOIN member m ON m.url = t.url LEFT JOIN down d ON d.url = t.url)
"""
sql("p3_found", _TREE_SQL + "SELECT url, root AS root_url, depth AS tree_depth, descendants, cycle_state FROM tree")
sql("p3_paths", _TREE_SQL + """,
above AS (SELECT r.url, string_agg(r.anc, ' > ' ORDER BY v.depth) AS names FROM reach r JOIN level v ON v.url = r.anc GROUP BY r.url)
SELECT t.url AS node, t.p AS parent, t.root, t.depth, t.descendants, t.cycle_state, CASE WHEN t.cycle_state = 'none' THEN coalesce(a.names || ' > ', '') || t.url END AS path
FROM tree t LEFT JOIN above a ON a.url = t.url
""")
