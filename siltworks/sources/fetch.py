"""Pages, robots files and model calls from injected functions, so that plans run offline and on a cluster alike."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host

RATE_LIMITED, FATAL = "retry", "failed"
PAGE = "url string, html string, error string, outcome string, retry_after double"


def fetch_pages(urls: DataFrame, fetch: Callable[[str], str], spread: int | None = None, per_host: int | None = None, delay: float = 0.0) -> DataFrame:
    """(url, html, error, outcome, retry_after) of each url by a function that gives HTML or raises.

    An exception with ``status`` 429, or whose response has it, is retried later (``retry_after``
    seconds); status 400 to 499 fails at once; anything else is retried. ``spread`` deals the urls
    over so many tasks, since a call takes longer than a row. With ``per_host`` a host's urls
    are dealt over so many tasks at most, each of which fetches them one after the other, so no host gets more
    requests at a time; starts of one host lie ``delay`` seconds apart on average then.
    """

    def run(batches):
        due: dict[str, float] = {}
        for b in batches:
            out = []
            for u in b["url"]:
                if delay and per_host:
                    at = u.split("/", 3)[2].lower() if u.count("/") >= 2 else u
                    time.sleep(max(0.0, due.get(at, 0.0) - time.monotonic()))
                    due[at] = time.monotonic() + delay * per_host
                try:
                    out.append((u, fetch(u), None, None, None))
                except Exception as e:  # noqa: BLE001
                    status = getattr(e, "status", None) or getattr(getattr(e, "response", None), "status_code", None) or 0
                    kind = RATE_LIMITED if status == 429 or not 400 <= status < 500 else FATAL
                    out.append((u, None, f"{type(e).__name__}: {e}"[:500], kind, 5.0 if status == 429 else None))
            yield pd.DataFrame(out, columns=["url", "html", "error", "outcome", "retry_after"])

    rows = urls.select("url")
    if per_host:
        if per_host < 1:
            raise ValueError("per_host must be positive")
        slot = F.pmod(F.xxhash64("url"), F.lit(per_host))
        tasks = spread or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.select("url", host(F.col("url")).alias("_h"), slot.alias("_slot")).repartition(tasks, "_h", "_slot").select("url")
    elif spread:
        rows = rows.repartition(spread)
    return rows.mapInPandas(run, PAGE)


def fetch_text(hosts: DataFrame, fetch: Callable[[str], str | None], name: str = "robots.txt", scheme: str = "https") -> DataFrame:
    """(host, text) of one file of each distinct host; null where the function gives none or raises."""

    def run(batches):
        for b in batches:
            out = []
            for h in b["host"]:
                try:
                    out.append((h, fetch(f"{scheme}://{h}/{name}")))
                except Exception:  # noqa: BLE001
                    out.append((h, None))
            yield pd.DataFrame(out, columns=["host", "text"])

    return hosts.select("host").where("host is not null").distinct().mapInPandas(run, "host string, text string")


def call_model(df: DataFrame, prompt: str, make: Callable[[], Callable[[str], str]], out: str = "response", longest: int = 4000) -> DataFrame:
    """df with a model's response to a text column and ``error``; one client per task, texts cut to ``longest`` characters."""

    def run(batches):
        ask = make()
        for b in batches:
            got, bad = [], []
            for t in b[prompt]:
                try:
                    got.append(None if t is None else ask(t[:longest]))
                    bad.append(None)
                except Exception as e:  # noqa: BLE001
                    got.append(None)
                    bad.append(f"{type(e).__name__}: {e}"[:500])
            yield b.assign(**{out: got, "error": bad})

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{kind}, {out} string, error string")


def embedded(df: DataFrame, text: str, embed: Callable[[list[str]], list[list[float]]], longest: int = 4000, out: str = "_v") -> DataFrame:
    """df with the vector of the first ``longest`` characters of a text column, embedded batch by batch."""

    def run(batches):
        for b in batches:
            yield b.assign(**{out: list(embed([(t or "")[:longest] for t in b[text]]))})

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{kind}, {out} array<float>")


def cosine_scores(pages: DataFrame, text: str, embed: Callable[[list[str]], list[list[float]]], intent: list[float] | None, longest: int = 4000) -> DataFrame:
    """pages with ``score``: cosine of the first ``longest`` characters of a text with an intent; 1.0 where there is no intent."""
    from ..functions.vectors import cosine

    if intent is None:
        return pages.withColumn("score", F.lit(1.0))
    return embedded(pages, text, embed, longest).withColumn("score", cosine(F.col("_v"), F.array(*[F.lit(float(x)) for x in intent]))).drop("_v")


def heading_scores(pages: DataFrame, text: str, embed: Callable[[list[str]], list[list[float]]], intent: list[float] | None, longest: int = 4000) -> DataFrame:
    """pages with ``score``: cosine of a page's headings, or of the page where it has none, with an intent; 1.0 where there is no intent."""
    lines = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x: F.trim(x)), lambda x: x.startswith("#"))
    heads = F.array_join(lines, "\n")
    asked = pages.withColumn("_asked", F.when(heads == "", F.col(text)).otherwise(heads))
    return cosine_scores(asked, "_asked", embed, intent, longest).drop("_asked")


def score_by(embed: Callable[[list[str]], list[list[float]]] | None, intent: str | None, text: str = "markdown") -> Callable[[DataFrame], DataFrame]:
    """The gate of a crawl: pages scored by their headings; every page scores 1.0 without an intent or an embedding."""
    vector = None if embed is None or not intent else [float(x) for x in embed([intent])[0]]
    return lambda pages: heading_scores(pages, text, embed, vector)
