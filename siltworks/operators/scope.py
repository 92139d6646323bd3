"""Crawl scope: branches, prefixes, decisions, sections by seed prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import branch, host, path, path_segments


def branches(links: DataFrame, url: str, home: str) -> DataFrame:
    """(category, urls): distinct links of a start page by branch, null links left out."""
    rows = links.where(F.col(url).isNotNull())
    return rows.groupBy(branch(F.col(url), home).alias("category")).agg(F.sort_array(F.collect_set(url)).alias("urls"))


def derive_prefixes(df: DataFrame, group: str, url: str) -> DataFrame:
    """(group, host, prefix, degenerate): the longest common directory of each group's paths.

    With one distinct path its directory counts. The common prefix of a set of paths
    is that of the smallest and the largest one by segments, so two aggregates
    suffice. ``prefix`` ends in ``/``; it is null, and ``degenerate`` true, if only the root is shared.
    """
    segs = path_segments(F.col(url))
    g = df.where(F.col(url).isNotNull()).groupBy(group).agg(F.min(host(F.col(url))).alias("host"), F.min(segs).alias("lo"), F.max(segs).alias("hi"), F.min(path(F.col(url))).alias("p0"), F.max(path(F.col(url))).alias("p1"))
    agree = F.filter(F.transform(F.sequence(F.lit(0), F.size("lo")), lambda i: F.when(F.slice("lo", 1, i) == F.slice("hi", 1, i), i)), lambda x: x.isNotNull())
    n = F.when(F.col("p0") == F.col("p1"), F.greatest(F.size("lo") - 1, F.lit(0))).otherwise(F.array_max(agree))
    out = g.select(group, "host", F.slice("lo", F.lit(1), n).alias("common"))
    prefix = F.when(F.size("common") > 0, F.concat(F.lit("/"), F.array_join("common", "/"), F.lit("/")))
    return out.select(group, "host", prefix.alias("prefix"), (F.size("common") == 0).alias("degenerate"))


def scope_reason(url: Column, home: Column, prefix: Column, visited: Column | None = None) -> Column:
    """``already_visited``, ``off_host``, ``outside_prefix`` or ``accepted`` of a url in normal form, in this order."""
    out = F.when(visited, "already_visited") if visited is not None else None
    off = host(url).isNull() | (host(url) != F.lower(home))
    out = out.when(off, "off_host") if out is not None else F.when(off, "off_host")
    return out.when(prefix.isNotNull() & ~F.concat(path(url), F.lit("/")).startswith(prefix), "outside_prefix").otherwise("accepted")


def in_any_scope(df: DataFrame, url: str, scopes: DataFrame) -> DataFrame:
    """Rows whose url is under any of scopes(host, prefix); a null prefix is the whole host.

    The prefix test becomes an equi-join: a url is exploded into its host and its
    own path prefixes, of which one must be a scope.
    """
    segs = path_segments(F.col(url))
    own = F.transform(F.sequence(F.lit(0), F.size(segs)), lambda i: F.when(i == 0, F.lit("/")).otherwise(F.concat(F.lit("/"), F.array_join(F.slice(segs, F.lit(1), i), "/"), F.lit("/"))))
    keys = df.select(F.col(url).alias("_u"), host(F.col(url)).alias("_h"), F.explode(own).alias("_p")).distinct()
    wanted = scopes.select(F.lower("host").alias("_h"), F.coalesce("prefix", F.lit("/")).alias("_p")).distinct()
    hit = keys.join(wanted, ["_h", "_p"], "left_semi").select(F.col("_u").alias(url)).distinct()
    return df.join(hit, url, "left_semi")


def sections(df: DataFrame, url: str, seeds: DataFrame | None = None, depth: int = 2, out: str = "section_label") -> DataFrame:
    """df with the section of each url: ``depth`` segments after the longest matching seed prefix, else after the root.

    seeds(host, prefix); urls without further segments are ``root``.
    """
    if depth < 1:
        raise ValueError("depth must be positive")
    segs = path_segments(F.col(url))
    if seeds is None:
        skip = F.lit(0)
        base = df
    else:
        own = F.transform(F.sequence(F.lit(1), F.greatest(F.size(segs), F.lit(1))), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(segs, F.lit(1), i), "/"), F.lit("/")))
        keys = df.where(F.col(url).isNotNull()).select(F.col(url).alias("_u"), host(F.col(url)).alias("_h"), F.posexplode(own).alias("_i", "_p")).distinct()
        wanted = seeds.where("prefix is not null").select(F.lower("host").alias("_h"), F.col("prefix").alias("_p")).distinct()
        best = keys.join(wanted, ["_h", "_p"]).groupBy("_u").agg((F.max("_i") + 1).alias("_skip"))
        base = df.join(best, F.col(url) == F.col("_u"), "left").drop("_u")
        skip = F.coalesce("_skip", F.lit(0))
    label = F.array_join(F.slice(segs, skip + 1, F.lit(depth)), "/")
    return base.withColumn(out, F.when(label == "", "root").otherwise(label)).drop("_skip")
