"""The crawl as waves: each wave is one plan over claimed urls, and its result one written snapshot of the frontier, from which a crash resumes."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import cut
from ..functions.html import page
from ..functions.qajson import parse_pairs
from ..functions.robots import allowed
from ..functions.splitter import chunks
from ..functions.text import licence_signal, page_title
from ..functions.urls import host, resolve_url
from ..operators import frontier as Q
from ..operators.chunks import top_units
from ..operators.scope import in_any_scope, sections
from ..sources.fetch import call_model, embedded, fetch_pages
from ..sources.snapshots import open_snapshot, save_snapshot

PER_CHUNK, FIRST_CHARS, TOP_CHUNKS = "per_chunk", "first_n_chars", "top_k_chunks_by_relevance"


def extraction_units(pages: DataFrame, strategy: str = PER_CHUNK, size: int = 2000, overlap: int = 200, longest: int = 4000, embed: Callable[[list[str]], list[list[float]]] | None = None, intent: list[float] | None = None, k: int = 3) -> DataFrame:
    """pages with ``chunk_index`` and ``source_chunk``, one row a unit; a page without units keeps one row with nulls.

    ``per_chunk`` takes all chunks in order, ``first_n_chars`` the first ``longest`` characters,
    ``top_k_chunks_by_relevance`` the ``k`` chunks nearest to the intent, best first, ties in order; without an
    intent or an embedding there is nothing to rank by and all chunks are taken.
    """
    if strategy == FIRST_CHARS:
        units = F.array(F.substring("markdown", 1, longest))
    elif strategy in (PER_CHUNK, TOP_CHUNKS):
        units = chunks(F.col("markdown"), size, overlap)
    else:
        raise ValueError(f"unknown extraction strategy {strategy!r}")
    rows = pages.select("*", F.posexplode_outer(units).alias("chunk_index", "source_chunk"))
    if strategy != TOP_CHUNKS or embed is None or intent is None:
        return rows
    whole = rows.where("source_chunk is not null").withColumnRenamed("chunk_index", "position")
    best = top_units(embedded(whole, "source_chunk", embed, longest), "url", "_v", intent, k).select("url", "chunk_index", "position")
    kept = rows.withColumnRenamed("chunk_index", "position").join(best, ["url", "position"], "left")
    return kept.where("chunk_index is not null or source_chunk is null").select(*rows.columns)


def extract_records(pages: DataFrame, ask: Callable[[], Callable[[str], str]], model: str, at: Column, strategy: str = PER_CHUNK, size: int = 2000, overlap: int = 200, longest: int = 4000, embed: Callable[[list[str]], list[list[float]]] | None = None, intent: list[float] | None = None, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """(records, outcomes) of pages(url, markdown, section): units, a model's pairs, canonical records.

    A page fails only if it has units and none of them could be parsed. ``chunk_index`` is the unit's number.
    """
    read = pages.select("url", "section", "markdown", page_title(F.col("markdown")).alias("page_title"), licence_signal(F.col("markdown")).alias("license_signal"))
    rows = extraction_units(read, strategy, size, overlap, longest, embed, intent, k).drop("markdown")
    answered = cut(call_model(rows, "source_chunk", ask, longest=longest).withColumn("pairs", parse_pairs(F.col("response"))))
    outcome = answered.groupBy("url").agg(
        F.count("source_chunk").alias("n"), F.bool_or(F.col("pairs").isNotNull()).alias("any"), F.max("error").alias("error")
    ).select("url", F.when((F.col("n") == 0) | F.col("any"), "done").otherwise("retry").alias("outcome"), "error")
    flat = answered.where("pairs is not null").select("*", F.explode("pairs").alias("p"))
    records = flat.select(
        F.col("p.instruction").alias("question"), F.col("p.response").alias("answer"), "source_chunk", "chunk_index", F.col("url").alias("source_url"), "section", "page_title",
        F.lit(model).alias("generation_model"), F.lit(strategy).alias("extraction_strategy"), at.alias("timestamp"), F.substring(at, 1, 10).alias("crawl_date"), "license_signal",
    )
    return records, outcome


def wave(front: DataFrame, fetch: Callable[[str], str], scopes: DataFrame, at: Column, policies: DataFrame | None = None, score: Callable[[DataFrame], DataFrame] | None = None, extract_threshold: float = 0.0, follow_threshold: float = 0.0, max_depth: int | None = None, max_pages: int | None = None, batch: int | None = None, extract: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None, write: Callable[[DataFrame], None] | None = None, claimed: DataFrame | None = None, per_host: int | None = None, delay: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(frontier, pages) after one wave; pages(url, markdown, score, section) passed the extraction gate.

    policies(host, rules) hold robots rules; a host without any is open. ``score`` adds a
    ``score`` to pages, without it every page scores 1.0. ``extract`` makes (records, outcomes) of the pages that passed:
    a page whose outcome is ``retry`` counts an attempt and is queued again, though its score already
    decides over its children; ``write`` stores the records before any page is done. ``claimed`` are urls in progress already.
    ``per_host`` and ``delay`` bound the requests of a host, see :func:`fetch_pages`.
    """
    if claimed is None:
        claimed = cut(Q.claimable(front, at, batch, max_pages))
        front = Q.claim(front, claimed, at)
    ok = claimed
    if policies is not None:
        ruled = claimed.join(policies.select("host", "rules"), "host", "left")
        ok = ruled.withColumn("_ok", F.col("rules").isNull() | allowed(F.col("url"), F.col("rules"))).where("_ok")
    got = cut(fetch_pages(ok, fetch, per_host=per_host, delay=delay))
    denied = claimed.join(ok.select("url"), "url", "left_anti").select("url", F.lit("failed").alias("outcome"), F.lit("disallowed by robots.txt").alias("error"), F.lit(None).cast("double").alias("retry_after"))
    read = cut(got.where("outcome is null").join(claimed.select("url", "depth", "section_label"), "url").withColumn("p", page(F.col("html"))).select("url", "depth", "section_label", "p.markdown", "p.hrefs"))
    scored = cut((score(read) if score else read.withColumn("score", F.lit(1.0))).select("url", "markdown", "score", F.col("section_label").alias("section")))
    links = read.select(F.col("url").alias("parent_url"), F.col("depth").alias("parent_depth"), F.explode("hrefs").alias("href")).withColumn("url", resolve_url(F.col("href"), F.col("parent_url"))).where("url is not null")
    children = sections(in_any_scope(links, "url", scopes), "url", scopes)
    front = Q.insert_children(front, children.select("url", "parent_url", "parent_depth", F.col("section_label")), at, max_depth)
    passed = scored.where(F.col("score") >= extract_threshold)
    outcome = F.when(F.col("score") < extract_threshold, "skipped_extract").otherwise("done")
    final = scored.select("url", outcome.alias("outcome"), "score", F.lit(None).cast("string").alias("error"), F.lit(None).cast("double").alias("retry_after"))
    if extract is not None:
        records, told = extract(passed)
        told = cut(told.select("url", F.col("outcome").alias("_o"), F.col("error").alias("_e"), (F.col("retry_after") if "retry_after" in told.columns else F.lit(None).cast("double")).alias("_r")))
        if write is not None:
            write(records.join(told.where("_o = 'done'").select(F.col("url").alias("source_url")), "source_url", "left_semi"))
        final = final.join(told, "url", "left").select("url", F.when(F.col("outcome") == "done", F.coalesce("_o", "outcome")).otherwise(F.col("outcome")).alias("outcome"), "score", F.coalesce("_e", "error").alias("error"), F.col("_r").alias("retry_after"))
    lost = got.where("outcome is not null").select("url", "outcome", "error", "retry_after").unionByName(denied).select("url", "outcome", F.lit(None).cast("double").alias("score"), "error", "retry_after")
    due = Q.now_text(F.try_to_timestamp(at) + F.make_dt_interval(secs=F.coalesce("retry_after", F.lit(0.0)).cast("decimal(18,6)")))
    all_ = final.unionByName(lost).select("url", "outcome", "score", "error", F.when(F.col("retry_after").isNotNull(), due).alias("not_before"))
    return cut(Q.resolve(front, all_, at, follow_threshold)), passed


def _seconds(earlier: str, later: str) -> float:
    return (datetime.fromisoformat(later) - datetime.fromisoformat(earlier)).total_seconds()


def crawl(spark: SparkSession, seeds: DataFrame, fetch: Callable[[str], str], scopes: DataFrame, times: Callable[[int], Column] | None = None, waves: int | None = None, on_pages: Callable[[DataFrame, int], None] | None = None, store: str | None = None, wait: Callable[[float], None] = time.sleep, longest_wait: float = 60.0, **gates) -> DataFrame:
    """The frontier when nothing is left to do, the page cap is met, or ``waves`` waves are over, if given.

    With ``store``, a folder, the frontier of an earlier run is reopened: what was in
    progress counts one attempt more, seeds that are known stay as they are. The claim of a wave and
    its outcome are written there as snapshots, so a crash loses at most the wave it falls in.
    If only urls are left that may not be fetched yet, the crawl waits for the first of them.
    """
    clock = times or (lambda k: Q.now_text())
    keep = (lambda f: save_snapshot(f, store)) if store else cut
    front = open_snapshot(spark, store, Q.COLUMNS) if store else spark.createDataFrame([], Q.COLUMNS)
    front = keep(Q.seed(Q.recover(front, clock(0)), seeds, clock(0)))
    k = done = 0
    while waves is None or done < waves:
        at = clock(k)
        claimed = cut(Q.claimable(front, at, gates.get("batch"), gates.get("max_pages")))
        if not claimed.limit(1).count():
            cap = gates.get("max_pages")
            if cap is not None and front.where(F.col("status").isin("done", "skipped_extract")).count() >= cap:
                break
            row = front.where("status = 'queued'").agg(F.min("not_before").alias("due"), F.max(at).alias("now")).first()
            if row["due"] is None:
                break
            wait(min(longest_wait, max(0.0, _seconds(row["now"] or spark.range(1).select(at).first()[0], row["due"]))))
            k += 1
            continue
        front = keep(Q.claim(front, claimed, at))
        front, passed = wave(front, fetch, scopes, at, claimed=claimed, **gates)
        front = keep(front)
        if on_pages:
            on_pages(passed, done)
        k += 1
        done += 1
    return front


def policies(spark: SparkSession, hosts: DataFrame, fetch: Callable[[str], str | None], agent: str = "*") -> DataFrame:
    """(host, rules, crawl_delay, sitemaps, robots_found, sitemap_found, sitemap_root_tag, llms_found, llms) of each distinct host.

    The sitemap is the one at its usual place; what is there without a root element is none.
    """
    from ..functions.robots import policy
    from ..sources.fetch import fetch_text

    robots = fetch_text(hosts, fetch).withColumn("p", policy(F.col("text"), agent)).select("host", "p.rules", "p.crawl_delay", "p.sitemaps", F.col("text").isNotNull().alias("robots_found"))
    tag = F.nullif(F.regexp_extract("text", r"^\s*(?:<\?[^>]*>\s*|<!--.*?-->\s*|<![^>]*>\s*)*<([A-Za-z_][\w.:-]*)", 1), F.lit(""))
    maps = fetch_text(hosts, fetch, "sitemap.xml").select("host", tag.alias("sitemap_root_tag")).withColumn("sitemap_found", F.col("sitemap_root_tag").isNotNull())
    llms = fetch_text(hosts, fetch, "llms.txt").select("host", F.col("text").isNotNull().alias("llms_found"), F.col("text").alias("llms"))
    return robots.join(maps, "host").join(llms, "host")


def hosts_of(front: DataFrame) -> DataFrame:
    return front.select(host(F.col("url")).alias("host")).distinct()
