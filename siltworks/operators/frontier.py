"""The crawl frontier as a table: every transition is a plan from one snapshot to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import host

STATUSES = ("queued", "pending_score", "in_progress", "done", "skipped_follow", "skipped_extract", "failed")
COLUMNS = "url string, host string, depth int, section_label string, parent_url string, status string, relevance_score double, retry_count int, last_error string, not_before string, created_at string, updated_at string"
MAX_RETRIES = 3
GATE_FREE_DEPTH = 0


def now_text(at: Column | None = None) -> Column:
    """A time as ISO-8601 text in UTC with microseconds."""
    return F.date_format(at if at is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def check(front: DataFrame) -> DataFrame:
    """The frontier, in which an unknown status fails the query."""
    bad = F.when(~F.col("status").isin(*STATUSES) | F.col("status").isNull(), F.raise_error(F.concat(F.lit("unknown status "), F.coalesce("status", F.lit("null"))))).otherwise(F.col("status"))
    return front.withColumn("status", bad.cast("string"))


def _added(front: DataFrame, rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows whose url the frontier lacks, the first of each url."""
    first = rows.groupBy("url").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "url"]), F.struct(*order)).alias("r")).select("url", "r.*")
    return first.join(front.select("url"), "url", "left_anti").select(*front.columns)


def _blank(rows: DataFrame, at: Column, **values: Column) -> DataFrame:
    typed = {f.split()[0]: f.split()[1] for f in COLUMNS.split(", ")}
    have = {"host": host(F.col("url")), "retry_count": F.lit(0), "created_at": at, "updated_at": at, **values}
    return rows.select("url", *[have.get(c, F.lit(None)).cast(t).alias(c) for c, t in typed.items() if c != "url"])


def seed(front: DataFrame, urls: DataFrame, at: Column) -> DataFrame:
    """Frontier with unknown urls added at depth 0, queued; known ones stay as they are."""
    rows = _blank(urls.where("url is not null").select("url"), at, depth=F.lit(0), status=F.lit("queued"))
    return front.unionByName(_added(front, rows, [F.col("created_at")]))


def insert_children(front: DataFrame, children: DataFrame, at: Column, max_depth: int | None = None, free_depth: int = GATE_FREE_DEPTH) -> DataFrame:
    """Frontier with children(url, parent_url, parent_depth, section_label) added one level below their parent.

    Children of gate-free parents are queued, others wait for the parent's
    score. Urls that are known stay as they are (the first discoverer wins); of several new
    rows of one url the shallowest, then the smallest parent counts. Too deep ones are not added.
    """
    depth = F.col("parent_depth") + 1
    rows = children.where(F.col("url").isNotNull() & (depth <= max_depth if max_depth is not None else F.lit(True)))
    typed = _blank(rows.withColumn("_d", depth), at, depth=F.col("_d"), parent_url=F.col("parent_url"), section_label=F.col("section_label"), status=F.when(F.col("parent_depth") <= free_depth, "queued").otherwise("pending_score"))
    return front.unionByName(_added(front, typed, [F.col("depth"), F.col("parent_url")]))


def claimable(front: DataFrame, at: Column, batch: int | None = None, max_pages: int | None = None) -> DataFrame:
    """Urls to work on next: queued and due, oldest first, ties by url; at most ``batch`` and what is left of ``max_pages``."""
    due = front.where((F.col("status") == "queued") & (F.col("not_before").isNull() | (F.try_to_timestamp("not_before") <= F.try_to_timestamp(at))))
    limits = [x for x in (batch, None if max_pages is None else max(0, max_pages - front.where(F.col("status").isin("done", "skipped_extract")).count())) if x is not None]
    ordered = due.select("url", "host", "depth", "section_label", "parent_url", "retry_count", "created_at").orderBy("created_at", "url")
    return ordered.limit(min(limits)) if limits else ordered


def claim(front: DataFrame, claimed: DataFrame, at: Column) -> DataFrame:
    """Frontier with the claimed urls in progress."""
    hit = claimed.select("url", F.lit(True).alias("_hit"))
    j = front.join(hit, "url", "left")
    return j.withColumn("status", F.when(F.col("_hit"), "in_progress").otherwise(F.col("status"))).withColumn("updated_at", F.when(F.col("_hit"), at).otherwise(F.col("updated_at"))).select(*front.columns)


def resolve(front: DataFrame, outcomes: DataFrame, at: Column, follow: float = 0.0, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Frontier after outcomes(url, outcome, score, error, not_before), one row a url.

    ``done`` and ``skipped_extract`` are final; ``retry`` counts one more attempt and
    queues the url again, or fails it at ``max_retries``; ``failed`` fails it at once. A scored
    page releases its waiting children: queued if the score is ``follow`` or more, else
    skipped_follow. Children waiting under a failed page are skipped_follow.
    """
    o = outcomes.select("url", F.col("outcome").alias("_o"), F.col("score").alias("_s"), F.col("error").alias("_e"), F.col("not_before").alias("_nb"))
    j = front.join(o, "url", "left")
    tries = F.col("retry_count") + 1
    status = (
        F.when(F.col("_o").isin("done", "skipped_extract"), F.col("_o"))
        .when((F.col("_o") == "failed") | ((F.col("_o") == "retry") & (tries >= max_retries)), "failed")
        .when(F.col("_o") == "retry", "queued")
        .otherwise(F.col("status"))
    )
    hit = F.col("_o").isNotNull()
    moved = j.select(
        "url", "host", "depth", "section_label", "parent_url",
        status.alias("status"),
        F.coalesce("_s", "relevance_score").alias("relevance_score"),
        F.when(F.col("_o").isin("retry", "failed"), tries).otherwise(F.col("retry_count")).cast("int").alias("retry_count"),
        F.when(hit & F.col("_e").isNotNull(), F.col("_e")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(F.col("_o") == "retry", F.col("_nb")).otherwise(F.col("not_before")).alias("not_before"),
        "created_at",
        F.when(hit, at).otherwise(F.col("updated_at")).alias("updated_at"),
        hit.alias("_hit"), F.col("_s").alias("_scored"),
    )
    # a score decides over the children when it is given, whatever becomes of the page after
    verdict = F.when(F.coalesce(F.col("_scored"), F.when(F.col("status") != "failed", F.col("relevance_score"))) >= follow, "queued").otherwise("skipped_follow")
    release = moved.where("_hit and (status = 'failed' or relevance_score is not null)").select(F.col("url").alias("parent_url"), verdict.alias("_child"))
    out = moved.join(release, "parent_url", "left")
    waits = (F.col("status") == "pending_score") & F.col("_child").isNotNull()
    return out.withColumn("status", F.when(waits, F.col("_child")).otherwise(F.col("status"))).withColumn("updated_at", F.when(waits, at).otherwise(F.col("updated_at"))).select(*front.columns)


def recover(front: DataFrame, at: Column, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Frontier after a crash: what was in progress counts one attempt more and is queued again, or failed; children under newly failed pages are skipped."""
    lost = front.where("status = 'in_progress'").select("url", F.lit("retry").alias("outcome"), F.lit(None).cast("double").alias("score"), F.lit("interrupted").alias("error"), F.lit(None).cast("string").alias("not_before"))
    return resolve(front, lost, at, max_retries=max_retries)


def counts(front: DataFrame) -> DataFrame:
    return front.groupBy("status").agg(F.count("*").alias("n"))


def quiescent(front: DataFrame) -> DataFrame:
    """One row: open urls, waiting urls whose parent is final or missing (none may be), and whether the crawl is over."""
    parents = front.select(F.col("url").alias("parent_url"), F.col("status").alias("_ps"))
    waiting = front.where("status = 'pending_score'").join(parents, "parent_url", "left")
    stray = waiting.where("_ps is null or _ps in ('done', 'skipped_extract', 'skipped_follow', 'failed')").agg(F.count("*").alias("stray"))
    open_ = front.agg(F.count_if(F.col("status").isin("queued", "in_progress")).alias("open"))
    return open_.crossJoin(stray).withColumn("over", F.col("open") == 0)


def scores(front: DataFrame) -> DataFrame:
    """(url, relevance_score, status) of scored pages, best first, ties by url."""
    return front.where("relevance_score is not null").select("url", "relevance_score", "status").orderBy(F.desc("relevance_score"), "url")


def in_progress(front: DataFrame, n: int = 20) -> DataFrame:
    return front.where("status = 'in_progress'").select("url", "updated_at").orderBy(F.desc("updated_at"), "url").limit(n)


def start_times(requests: DataFrame, by: str, arrival: str, key: str, delay: Column, width: float = 3600.0) -> DataFrame:
    """requests with ``start``: seconds at which each may begin if starts of one host lie ``delay`` apart, in order of arrival.

    The recursion start = max(previous + delay, arrival) is a running maximum of
    arrival - delay * position, so no state is kept. Requests are numbered in
    spans of ``width`` seconds, and spans are joined by their counts and maxima, so the requests of a
    crowded host are not sorted in one task. ``delay`` is one number a host; null hosts are one host.
    """
    if width <= 0:
        raise ValueError("width must be positive")
    rows = requests.withColumn("_d", delay).withColumn("_h", F.coalesce(F.col(by).cast("string"), F.lit("\u0000"))).withColumn("_b", F.floor(F.col(arrival) / F.lit(width)))
    own = Window.partitionBy("_h", "_b").orderBy(arrival, key)
    before = Window.partitionBy("_h").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy("_h", "_b").agg(F.count("*").alias("_n")).select("_h", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    placed = rows.withColumn("_k", F.row_number().over(own) - 1).join(counted, ["_h", "_b"]).withColumn("_k", F.col("_k") + F.col("_first"))
    slack = placed.withColumn("_s", F.col(arrival) - F.col("_d") * F.col("_k"))
    reached = slack.groupBy("_h", "_b").agg(F.max("_s").alias("_m")).select("_h", "_b", F.max("_m").over(before).alias("_top"))
    inside = F.max("_s").over(own.rowsBetween(Window.unboundedPreceding, 0))
    out = slack.withColumn("_s", inside).join(reached, ["_h", "_b"])
    return out.withColumn("start", F.greatest("_s", "_top") + F.col("_d") * F.col("_k")).select(*requests.columns, "start")
