"""What the branches of one root page hold and what each would accept, before anything is crawled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import page
from ..functions.urls import branch, host, normal_url, resolve_url
from ..operators.scope import derive_prefixes, scope_reason
from ..sources.fetch import fetch_pages


def root_links(spark: SparkSession, root: str, fetch: Callable[[str], str]) -> DataFrame:
    """(href, url) of the links of a root page, fetched once; url is null for what is no http address."""
    got = fetch_pages(spark.createDataFrame([(root,)], "url string"), fetch)
    read = got.select("url", F.coalesce("html", F.raise_error(F.concat(F.lit("root page not read: "), F.coalesce("error", F.lit(""))))).alias("html"))
    hrefs = read.select("url", F.explode(page(F.col("html"))["hrefs"]).alias("href"))
    return hrefs.select("href", resolve_url(F.col("href"), F.col("url")).alias("url")).distinct()


def _home(spark: SparkSession, root: str) -> str:
    return spark.range(1).select(host(normal_url(F.lit(root)))).first()[0] or ""


def branch_scopes(links: DataFrame, root: str) -> DataFrame:
    """(section, host, prefix) of each branch of a root page's links; a null prefix is the whole host."""
    rows = links.where("url is not null").withColumn("section", branch(F.col("url"), _home(links.sparkSession, root)))
    return derive_prefixes(rows, "section", "url").select("section", "host", "prefix")


def branch_seeds(links: DataFrame, root: str, sections: list[str] | None = None) -> DataFrame:
    """(url) of a root page's links in the named branches, or in all on the page's own host."""
    home = _home(links.sparkSession, root)
    rows = links.where("url is not null")
    return rows.where(branch(F.col("url"), home).isin(*sections) if sections else host(F.col("url")) == home).select("url").distinct()


def decisions(links: DataFrame, root: str) -> DataFrame:
    """(section, url, allowed, reason) of every link under the scope of every branch; the branches are those of one page and so few."""
    scopes = branch_scopes(links, root).collect()
    if not scopes:
        return links.sparkSession.createDataFrame([], "section string, url string, allowed boolean, reason string")
    listed = F.array(*[F.struct(F.lit(r["section"]).alias("section"), F.lit(r["host"]).alias("host"), F.lit(r["prefix"]).cast("string").alias("prefix")) for r in scopes])
    rows = links.where("url is not null").select("url", F.explode(listed).alias("s"))
    reason = scope_reason(F.col("url"), F.col("s.host"), F.col("s.prefix"))
    return rows.select(F.col("s.section").alias("section"), "url", (reason == "accepted").alias("allowed"), reason.alias("reason"))
