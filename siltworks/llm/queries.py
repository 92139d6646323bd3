"""Registered queries of the language-model operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.urls import BLANKS, named_section, normal_url
from .cross_split import leak_report, overlaps, record_pairs
from .defects import flag_defects
from .encoding import encode_corpus
from .leakage import LOOKALIKES, leaked_items, without_leaks
from .page_body import main_body, page_furniture
from .splits import entity_map, related_splits
from .stuffing import stuffed_pages
from .survivors import same_question_groups, survivors
from .splitting import split_oversized

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pieces(spark, d):
    chunks = split_oversized(table(spark, d, "chunks"), "chunks", "chunk_no", "parent_text")
    return chunks.unionByName(split_oversized(table(spark, d, "canonical"), "canonical", "record_id", "source_chunk"))


@query
def p1_found(spark, d):
    return _pieces(spark, d).groupBy("item_kind", "item_id").agg(F.min("cut").alias("cut"))


@query
def p1_pieces(spark, d):
    return _pieces(spark, d).select("item_kind", "item_id", "piece_no", "start", "boundary", "piece")


@query
def p1_joined(spark, d):
    """Each text put together again from its pieces, what each repeats of the one before left out."""
    before = Window.partitionBy("item_kind", "item_id").orderBy("piece_no")
    ends = _pieces(spark, d).withColumn("end", F.col("start") + F.length("piece")).withColumn("done", F.coalesce(F.lag("end").over(before), F.lit(0)))
    own = ends.withColumn("own", F.expr("substring(piece, cast(done - start + 1 as int))"))
    whole = own.groupBy("item_kind", "item_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "own"))).alias("x"), F.max(F.length("piece")).alias("longest"), F.bool_and((F.col("piece_no") == 0) | (F.col("done") - F.col("start") == F.least(F.lit(200), "done"))).alias("overlapped"))
    text = F.array_join(F.transform("x", lambda p: p["own"]), "")
    return whole.select("item_kind", "item_id", F.md5(text).alias("text_md5"), (F.col("longest") <= 2000).alias("within"), "overlapped")


SQL["p1_joined"] = """
SELECT 'chunks' AS item_kind, chunk_no AS item_id, md5(parent_text) AS text_md5, true AS within, true AS overlapped FROM chunks WHERE length(parent_text) > 2000
UNION ALL SELECT DISTINCT 'canonical', record_id, md5(source_chunk), true, true FROM canonical WHERE length(source_chunk) > 2000
"""
SQL["p1_found"] = r"""
WITH items AS (
  SELECT 'chunks' AS item_kind, chunk_no AS item_id, parent_text AS t FROM chunks
  UNION ALL
  SELECT DISTINCT 'canonical', record_id, source_chunk FROM canonical)
SELECT item_kind, item_id,
  CASE WHEN list_max(list_transform(regexp_split_to_array(t, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: length(x))) > 2000
    THEN 'forced' ELSE 'natural' END AS cut
FROM items WHERE length(t) > 2000
"""


def _section_keys():
    return {"page": normal_url(F.col("source_url")), "section": named_section(F.col("section"))}


@query
def p2_found(spark, d):
    _, comp = entity_map(table(spark, d, "canonical"), "record_id", _section_keys())
    s = comp.where(F.col("node").startswith("section\u0001")).select(F.substring_index("node", "\u0001", -1).alias("name"), "component")
    a, b = s.withColumnRenamed("name", "section_a"), s.withColumnRenamed("name", "section_b")
    return a.join(b, "component").where("section_a < section_b").select("section_a", "section_b")


SQL["p2_found"] = r"""
WITH RECURSIVE t AS (SELECT trim(source_url, ' ' || chr(9) || chr(10) || chr(13)) AS u, trim(lower(section), ' /' || chr(9) || chr(10) || chr(13)) AS s FROM canonical),
r AS (SELECT DISTINCT s, lower(regexp_extract(u, '^((?i:https?)://[^/?#]*)', 1)) || rtrim(regexp_extract(u, '^(?i:https?)://[^/?#]*([^?#]*)', 1), '/')
  || '?' || array_to_string(list_sort(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&')), '&') AS page FROM t WHERE s NOT IN ('', 'unknown', 'root')),
e AS (SELECT DISTINCT a.s AS a, b.s AS b FROM r a JOIN r b ON a.page = b.page WHERE a.s <> b.s),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT DISTINCT a AS section_a, b AS section_b FROM reach WHERE a < b
"""


@query
def p2_components(spark, d):
    """Each record's connected part, named by its smallest entity."""
    ents, comp = entity_map(table(spark, d, "canonical"), "record_id", _section_keys())
    first = ents.groupBy("record_id").agg(F.min(F.col("entities")[0]).alias("node"))
    return first.join(comp, "node").select("record_id", "component")


SQL["p2_components"] = r"""
WITH RECURSIVE t AS (SELECT record_id, trim(source_url, ' ' || chr(9) || chr(10) || chr(13)) AS u, trim(lower(section), ' /' || chr(9) || chr(10) || chr(13)) AS s FROM canonical),
r AS (SELECT DISTINCT record_id, CASE WHEN s NOT IN ('', 'unknown', 'root') THEN 'section' || chr(1) || s END AS section, 'page' || chr(1) || lower(regexp_extract(u, '^((?i:https?)://[^/?#]*)', 1))
  || coalesce(nullif(rtrim(regexp_extract(u, '^(?i:https?)://[^/?#]*([^?#]*)', 1), '/'), ''), '/')
  || CASE WHEN regexp_extract(u, '^[^?#]*\?([^#]*)', 1) <> '' THEN '?' || array_to_string(list_sort(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&')), '&') ELSE '' END AS page FROM t),
e AS (SELECT DISTINCT page AS a, section AS b FROM r WHERE section IS NOT NULL UNION SELECT DISTINCT section, page FROM r WHERE section IS NOT NULL),
reach(a, b) AS (SELECT DISTINCT page, page FROM r UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
SELECT DISTINCT record_id, component FROM r JOIN c ON c.a = r.page
"""


@query
def p2_splits(spark, d):
    return related_splits(table(spark, d, "canonical"), "record_id", _section_keys())


@query
def p2_shares(spark, d):
    """Records and components of each split, and its share of all records."""
    s = related_splits(table(spark, d, "canonical"), "record_id", _section_keys()).groupBy("split").agg(F.count("*").alias("records"), F.countDistinct("component").alias("components"))
    return s.select("split", "records", "components", F.round(F.col("records") / F.sum("records").over(Window.partitionBy()), 4).alias("share"))


@query
def p5_found(spark, d):
    members, pairs = overlaps(table(spark, d, "canonical"), table(spark, d, "record_splits"))
    return record_pairs(members, pairs).select("record_a", "record_b")


@query
def p5_report(spark, d):
    members, pairs = overlaps(table(spark, d, "canonical"), table(spark, d, "record_splits"))
    return leak_report(members.withColumn("section", named_section(F.col("section"))), pairs)


_WORDS_SQL = r"regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace({}, '!?\[([^\]\[]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)', '\1', 'g'), '</?[A-Za-z][^<>]*>', ' ', 'g'), '&(?:[a-zA-Z]{{2,8}}|#[0-9]{{1,7}});', ' ', 'g')), '[\p{{L}}\p{{N}}\p{{M}}]+')"
# the words matched in order by rows of the common subsequence: prefix maxima of what each next word can add
_PAIRS_SQL = rf"""
WITH l AS (SELECT record_id, CASE WHEN lower(trim(split_label)) LIKE 'tr%' THEN 't' WHEN lower(trim(split_label)) LIKE 'va%' OR lower(trim(split_label)) LIKE 'te%' THEN 'e' END AS side FROM record_splits),
c AS (SELECT record_id, min(question) AS q, min(coalesce(answer, '')) AS a FROM canonical GROUP BY record_id),
r AS (SELECT record_id, side, q, regexp_extract(lower(q), '[a-z0-9]+(?:_[a-z0-9]+)+') AS setting, {_WORDS_SQL.format("q || chr(10) || a")} AS w, {_WORDS_SQL.format("q")} AS qw,
  regexp_extract_all(regexp_replace(q, '\S*_\S*', ' ', 'g'), '[\p{{L}}\p{{M}}]+') AS found FROM c JOIN l USING (record_id) WHERE side IS NOT NULL),
n AS (SELECT record_id, side, setting, w, qw, CASE WHEN len(list_filter(found, lambda x: x = lower(x))) > 0
  THEN list_transform(list_filter(found[2:], lambda x: length(x) > 3 AND x[1] <> lower(x[1]) AND x <> upper(x)), lambda x: lower(x)) ELSE [] END AS names FROM r WHERE setting <> ''),
p AS (SELECT t.record_id AS x, e.record_id AS y, t.w AS wa, e.w AS wb, t.names AS na, e.names AS nb, t.qw AS qa, e.qw AS qb FROM n t JOIN n e ON t.setting = e.setting AND t.side = 't' AND e.side = 'e'
  WHERE t.record_id <> e.record_id AND 2 * least(len(t.w), len(e.w)) >= 0.8 * (len(t.w) + len(e.w))),
m AS (SELECT x, y, na, nb, qa, qb, len(wa) + len(wb) AS total, list_last(list_reduce(list_transform(wa, lambda v: list_transform(wb, lambda u: CASE WHEN u = v THEN 1 ELSE 0 END)),
  lambda row, hit: list_transform(range(1, len(hit) + 1), lambda i: list_max(list_transform(range(1, i + 1), lambda k: greatest(row[k], hit[k] * (CASE WHEN k > 1 THEN row[k - 1] ELSE 0 END + 1))))),
  list_transform(wb, lambda u: 0))) AS same FROM p),
lost AS (SELECT x, y, len(na) AS ka, len(nb) AS kb,
  len(list_filter(na, lambda v: len(list_filter(qb, lambda u: u = v OR (least(length(u), length(v)) > 3 AND abs(length(u) - length(v)) < 3 AND damerau_levenshtein(u, v) < 3))) = 0)) AS la,
  len(list_filter(nb, lambda v: len(list_filter(qa, lambda u: u = v OR (least(length(u), length(v)) > 3 AND abs(length(u) - length(v)) < 3 AND damerau_levenshtein(u, v) < 3))) = 0)) AS lb
  FROM m WHERE 2 * same >= 0.8 * total - 1e-9),
pairs AS (SELECT x, y FROM lost WHERE NOT (la > 0 AND (lb > 0 OR kb = 0)) AND NOT (lb > 0 AND ka = 0))
"""
SQL["p5_found"] = _PAIRS_SQL + "SELECT least(x, y) AS record_a, greatest(x, y) AS record_b FROM pairs"


@query
def p5_leaks(spark, d):
    """Per evaluation split and section: all labelled records and those that also occur in train."""
    return p5_report(spark, d).select("split", "section", "records", "leaked")


SQL["p5_leaks"] = _PAIRS_SQL + """,
told AS (SELECT DISTINCT record_id, CASE WHEN lower(trim(split_label)) LIKE 'va%' THEN 'validation' ELSE 'test' END AS split FROM record_splits WHERE lower(trim(split_label)) LIKE 'va%' OR lower(trim(split_label)) LIKE 'te%'),
named AS (SELECT record_id, min(trim(lower(section), ' /' || chr(9) || chr(10) || chr(13))) AS s FROM canonical GROUP BY record_id)
SELECT split, CASE WHEN s NOT IN ('', 'unknown', 'root') THEN s END AS section, count(DISTINCT record_id) AS records, count(DISTINCT CASE WHEN record_id IN (SELECT y FROM pairs) THEN record_id END) AS leaked
FROM told JOIN named USING (record_id) GROUP BY 1, 2
"""


@query
def p7_found(spark, d):
    return flag_defects(table(spark, d, "canonical"))


@query
def p9_found(spark, d):
    return leaked_items(table(spark, d, "documents"), table(spark, d, "benchmark_items")).select("doc_id", "item_id")


@query
def p9_clean_counts(spark, d):
    docs = table(spark, d, "documents")
    kept = without_leaks(docs.select("doc_id", "source"), leaked_items(docs, table(spark, d, "benchmark_items")))
    return kept.groupBy("source").agg(F.count("*").alias("documents"))


_LIKE = "".join(LOOKALIKES), "".join(LOOKALIKES.values())
_FOLD_SQL = (
    r"translate(lower(strip_accents(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(lower({}), '(?s)<!--.*?-->|</?[A-Za-z][^<>]*>', ' ', 'g'), '\[([^\]\[]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)', '\1', 'g'),"
    r" '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', ' '), 'ß', 'ss'),"
    r" '[''’‘ʼ`´\x{{AD}}\x{{34F}}\x{{180E}}\x{{200B}}-\x{{200F}}\x{{202A}}-\x{{202E}}\x{{2060}}-\x{{2064}}\x{{FEFF}}]|&#39;', '', 'g'))), '" + _LIKE[0] + "', '" + _LIKE[1] + "')"
)
_LEAK_SQL = rf"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all({_FOLD_SQL.format('text')}, '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all({_FOLD_SQL.format('text')}, '[\p{{L}}\p{{N}}]+') AS w FROM benchmark_items WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS gram FROM i, unnest(range(1, len(w) - 10)) AS t(k)),
h AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS gram FROM d, unnest(range(1, len(w) - 10)) AS t(k)),
leak AS (SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (gram))
"""
SQL["p9_found"] = _LEAK_SQL + "SELECT doc_id, item_id FROM leak"
SQL["p9_clean_counts"] = _LEAK_SQL + "SELECT source, count(*) AS documents FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM leak) GROUP BY source"


@query
def p10_found(spark, d):
    return stuffed_pages(table(spark, d, "documents")).select("doc_id")


@query
def p8_ids(spark, d):
    return encode_corpus(table(spark, d, "documents"))


@query
def p6_found(spark, d):
    return page_furniture(table(spark, d, "canonical"))


@query
def p6_bodies(spark, d):
    # redelivered rows are made one after their texts have become digests
    return main_body(table(spark, d, "canonical")).select("record_id", F.md5("body").alias("body_md5"), F.length("body").alias("chars")).distinct()


def _page_groups(spark, d):
    c = table(spark, d, "canonical")
    groups = same_question_groups(c, normal_url(F.col("source_url")))
    once = c.select("record_id", "answer", "question", "timestamp", "source_chunk", "generation_model").join(groups, "record_id").dropDuplicates(["record_id"])
    sizes = groups.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    length = F.length(F.btrim(F.coalesce("answer", F.lit("")), F.lit(BLANKS)))
    return once.join(sizes.select("group"), "group", "left_semi").withColumn("instant", F.expr("try_to_timestamp(timestamp)")).withColumn("chars", length)


@query
def p4_found(spark, d):
    bundles = {"answer": (["answer", "source_chunk", "generation_model"], [F.col("chars"), F.col("instant")]), "question": (["question", "timestamp"], [F.col("instant")])}
    return survivors(_page_groups(spark, d), "group", "record_id", bundles).select(F.col("record_first").alias("group_first"), "answer_from", "question_from")


@query
def p4_consistent(spark, d):
    bundles = {"answer": (["answer", "source_chunk", "generation_model"], [F.col("chars"), F.col("instant")]), "question": (["question", "source_chunk", "generation_model"], [F.col("instant")])}
    out = survivors(_page_groups(spark, d), "group", "record_id", bundles, dependencies=[("generation_model", "source_chunk")])
    return out.select(F.col("record_first").alias("group_first"), "answer_from", "question_from")
