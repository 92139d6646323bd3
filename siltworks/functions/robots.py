"""robots.txt: groups, rules, delays, sitemaps, and whether a path may be fetched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULE = T.StructType([T.StructField("directive", T.StringType()), T.StructField("pattern", T.StringType())])


_FIELDS = ("user-agent", "allow", "disallow", "crawl-delay")


def policy(text: Column, agent: str = "*") -> Column:
    """Struct of rules, crawl_delay, sitemaps of a robots.txt column, in the JVM; no rules for null.

    The lines that count are numbered by group: a group begins with an agent
    line that follows no other one. Rules and delay are those of the groups that name the
    agent, or else ``*``. An empty Disallow forbids nothing; an empty Allow matches
    everything with length 0. The last delay that is a number counts. Sitemap lines belong to no group.
    """
    raw = F.split(F.coalesce(text, F.lit("")), "\r\n|\n|\r")
    field = lambda x: F.lower(F.trim(F.substring_index(x, ":", 1)))
    value = lambda x: F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x)))
    told = F.filter(F.transform(raw, lambda x: F.trim(F.substring_index(x, "#", 1))), lambda x: F.contains(x, F.lit(":")) & field(x).isin(*_FIELDS))
    is_agent = lambda x: field(x) == "user-agent"
    begins = F.transform(told, lambda x, i: (is_agent(x) & ((i == 0) | ~is_agent(F.get(told, i - 1)))).cast("int"))
    numbers = F.aggregate(begins, F.array().cast("array<int>"), lambda acc, x: F.array_append(acc, F.coalesce(F.element_at(F.concat(F.array(F.lit(0)), acc), -1), F.lit(0)) + x))
    lines = F.zip_with(told, numbers, lambda x, g: F.named_struct(F.lit("g"), g, F.lit("field"), field(x), F.lit("value"), value(x)))
    of = lambda name: F.transform(F.filter(lines, lambda x: (x["field"] == "user-agent") & (F.lower(x["value"]) == name)), lambda x: x["g"])
    own = of(agent.lower())
    mine = F.when(F.size(own) > 0, own).otherwise(of("*"))
    inside = F.filter(lines, lambda x: F.array_contains(mine, x["g"]))
    rules = F.filter(inside, lambda x: (x["field"] == "allow") | ((x["field"] == "disallow") & (x["value"] != "")))
    delays = F.filter(F.transform(F.filter(inside, lambda x: x["field"] == "crawl-delay"), lambda x: x["value"].try_cast("double")), lambda x: x.isNotNull())
    maps = F.transform(F.filter(raw, lambda x: F.contains(x, F.lit(":")) & (field(x) == "sitemap") & (value(x) != "")), value)
    return F.struct(
        F.transform(rules, lambda x: F.named_struct(F.lit("directive"), x["field"], F.lit("pattern"), x["value"])).cast(T.ArrayType(RULE)).alias("rules"),
        F.get(F.reverse(delays), F.lit(0)).alias("crawl_delay"),
        maps.alias("sitemaps"),
    )


def pattern_regex(pattern: Column) -> Column:
    """A rule's pattern as a regular expression: ``*`` is any text, a closing ``$`` the end, all else literal."""
    anchored = pattern.endswith("$")
    body = F.when(anchored, F.expr("1")).isNotNull()
    core = F.when(body, F.regexp_replace(pattern, r"\$$", "")).otherwise(pattern)
    escaped = F.regexp_replace(core, r"([\\.\[\]{}()+?^$|])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(escaped, r"\*", ".*"), F.when(anchored, F.lit("$")).otherwise(F.lit("")))


def allowed(url: Column, rules: Column) -> Column:
    """Whether path and query of a url may be fetched: the longest matching pattern decides, Allow wins ties, no match allows."""
    target = F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    path = F.when(target == "", F.lit("/")).when(target.startswith("?"), F.concat(F.lit("/"), target)).otherwise(target)
    hits = F.filter(rules, lambda r: F.regexp_like(path, pattern_regex(r["pattern"])))
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.length(r["pattern"]).alias("n"), (r["directive"] == "allow").alias("ok"))))
    return F.coalesce(best["ok"], F.lit(True))
