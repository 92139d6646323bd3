"""The pipeline over streams: pages arrive as files, records and chunks leave exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.frontier import counts, in_progress
from ..sources.records import append_new_pages

PAGES = "url string, html string, fetched_at timestamp"


def page_stream(spark: SparkSession, path: str, schema: str = PAGES, files: int = 16) -> DataFrame:
    """Pages from a folder of parquet files, at most ``files`` of them a batch, which is the stream's backpressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run(stream: DataFrame, extract: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, also: Callable[[DataFrame, int], None] | None = None, forever: bool = False) -> StreamingQuery:
    """Records of a page stream appended to ``sink``; a page that was written is not written again, whatever is redelivered.

    ``extract`` makes records of a batch of pages, ``also`` gets the new ones (to upsert
    chunks, for instance) with the batch number. Ends when the source is drained unless ``forever``.
    """

    def each(batch: DataFrame, number: int) -> None:
        fresh = append_new_pages(batch.sparkSession, extract(batch), sink)
        if also:
            also(fresh, number)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime="1 second") if forever else w.trigger(availableNow=True)).start()


def spaced(requests: DataFrame, delay: float = 0.5) -> DataFrame:
    """requests(host, url, arrival double) with ``start``: starts of one host lie its ``delay`` apart over batches.

    State per host is the last start; requests of a batch go in order of arrival.
    """

    def place(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else float("-inf")
        rows = pd.concat(list(parts)).sort_values(["arrival", "url"])
        starts = []
        for a in rows["arrival"]:
            last = max(last + delay, a)
            starts.append(last)
        state.update((last,))
        yield pd.DataFrame({"host": key[0], "url": rows["url"], "arrival": rows["arrival"], "start": starts})

    return requests.groupBy("host").applyInPandasWithState(place, "host string, url string, arrival double, start double", "last double", "append", GroupStateTimeout.NoTimeout)


def rates(front: DataFrame, elapsed: float) -> DataFrame:
    """Counts by status and finished pages a minute, for a progress display."""
    done = F.count_if(F.col("status").isin("done", "skipped_extract"))
    return front.agg(done.alias("done"), F.count_if(F.col("status") == "in_progress").alias("in_flight"), F.round(done / F.lit(max(elapsed, 1e-9) / 60), 2).alias("pages_per_minute"))


def progress_text(front: DataFrame, elapsed: float, slots: int = 5) -> str:
    """A progress display for the console: counts by status, pages a minute, and the urls longest at work."""
    n = {r["status"]: r["n"] for r in counts(front).collect()}
    r = rates(front, elapsed).first()
    head = f"{r['done']} pages done, {r['pages_per_minute']:.2f} a minute, {r['in_flight']} at work, {n.get('queued', 0)} queued, {n.get('pending_score', 0)} waiting, {n.get('skipped_follow', 0) + n.get('skipped_extract', 0)} skipped, {n.get('failed', 0)} failed"
    return "\n".join([head, *(f"  {x['url']}" for x in in_progress(front, slots).collect())])
