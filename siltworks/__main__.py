"""Command line: crawl, dry-run, export, dataset-report, score-report, query."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def named(spec: str | None):
    """The object that ``module:name`` names; null for null."""
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def http_get(url: str) -> str:
    """The text of a url by the standard library; an error has its ``status``."""
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "siltworks"}), timeout=30) as r:
            return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except urllib.error.HTTPError as e:
        e.status = e.code
        raise


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltworks")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("crawl", help="crawl from a root page: frontier, records and chunk index in one folder")
    c.add_argument("root")
    c.add_argument("out")
    c.add_argument("--branch", action="append", help="branches of the root page to follow; all by default")
    c.add_argument("--fetch", default="siltworks.__main__:http_get", help="module:function from a url to HTML")
    c.add_argument("--ask", help="module:factory of a function from a text to a model's response; no records without it")
    c.add_argument("--embed", help="module:function from texts to vectors; no index and no gate without it")
    c.add_argument("--model", default="unknown", help="name of the generation model")
    c.add_argument("--embedding-model", default="unknown")
    c.add_argument("--intent", help="what the crawl is for; pages are gated by it")
    c.add_argument("--extract-threshold", type=float, default=0.0)
    c.add_argument("--follow-threshold", type=float, default=0.0)
    c.add_argument("--strategy", default="per_chunk")
    c.add_argument("--max-pages", type=int)
    c.add_argument("--max-depth", type=int)
    c.add_argument("--batch", type=int)
    c.add_argument("--per-host", type=int, help="requests of one host at a time")
    c.add_argument("--delay", type=float, default=0.0, help="seconds between the starts of one host's requests")
    d = sub.add_parser("dry-run", help="what each branch of a root page would accept and reject, without a crawl")
    d.add_argument("root")
    d.add_argument("--fetch", default="siltworks.__main__:http_get")
    e = sub.add_parser("export", help="records to a packaged training set")
    e.add_argument("records")
    e.add_argument("out")
    e.add_argument("--framework", default="plain-jsonl")
    e.add_argument("--schema", default="conversational")
    e.add_argument("--split-by", default="section")
    e.add_argument("--splitter", default="seeded", choices=["seeded", "hash"])
    e.add_argument("--parts", action="store_true", help="folders written by the tasks instead of single files")
    e.add_argument("--seed", type=int, default=42)
    e.add_argument("--min-answer-length", type=int, default=20)
    e.add_argument("--semantic-dedup", action="store_true")
    e.add_argument("--semantic-dedup-report", action="store_true")
    e.add_argument("--semantic-dedup-threshold", type=float, default=0.4)
    e.add_argument("--intent")
    r = sub.add_parser("dataset-report", help="counts of a dataset")
    r.add_argument("records")
    r.add_argument("--frontier")
    s = sub.add_parser("score-report", help="relevance scores of a stored frontier")
    s.add_argument("frontier")
    q = sub.add_parser("query", help="nearest chunks of an index to a text")
    q.add_argument("index")
    q.add_argument("text", help="a text, or without --embed a JSON list of numbers")
    q.add_argument("--embed")
    q.add_argument("--embedding-model", default="unknown")
    q.add_argument("-k", type=int, default=5)
    return p


def run_crawl(spark: SparkSession, a: argparse.Namespace):
    """Crawl into ``out``: frontier/, records/ and index/; a second call goes on where the first one stopped."""
    from .checkpoints import cut
    from .functions.splitter import parent_child
    from .operators.chunks import merge_chunks
    from .operators.frontier import now_text
    from .plans import crawl
    from .plans.dry_run import branch_scopes, branch_seeds, root_links
    from .sources import chunk_index
    from .sources.fetch import score_by
    from .sources.records import write_batch

    fetch, ask, embed = named(a.fetch), named(a.ask), named(a.embed)
    links = cut(root_links(spark, a.root, fetch))
    scopes = branch_scopes(links, a.root)
    scopes = cut(scopes.where(F.col("section").isin(*a.branch)) if a.branch else scopes.where(~F.col("section").startswith("External: ")))
    rules = crawl.policies(spark, crawl.hosts_of(scopes.select(F.concat(F.lit("https://"), "host").alias("url"))), fetch)
    intent = None if embed is None or not a.intent else [float(x) for x in embed([a.intent])[0]]

    def extract(pages):
        return crawl.extract_records(pages, ask, a.model, now_text(), a.strategy, embed=embed, intent=intent)

    def index(pages, _):
        if embed is not None:
            rows = parent_child(pages.select("url", "markdown"), "markdown")
            merged = merge_chunks(rows, "chunk", "url", "parent_text", [F.col("url"), F.col("parent_no"), F.col("child_no")])
            chunk_index.upsert(merged, f"{a.out}/index", embed, a.embedding_model, len(embed([""])[0]))

    more = {} if ask is None else {"extract": extract, "write": lambda r: write_batch(spark, r, f"{a.out}/records")}
    return crawl.crawl(
        spark, branch_seeds(links, a.root, a.branch), fetch, scopes, on_pages=index, store=f"{a.out}/frontier", policies=rules, score=score_by(embed, a.intent),
        extract_threshold=a.extract_threshold, follow_threshold=a.follow_threshold, max_pages=a.max_pages, max_depth=a.max_depth, batch=a.batch, per_host=a.per_host, delay=a.delay, **more,
    )


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)

    from .operators import frontier, reports
    from .operators.chunks import nearest
    from .plans.dry_run import decisions, root_links
    from .plans.export import export
    from .shipping import ship
    from .sources.chunk_index import CHUNKS, query_text
    from .sources.records import read_records_in_order
    from .sources.snapshots import open_snapshot

    spark = SparkSession.builder.appName("siltworks").getOrCreate()
    ship(spark)
    if a.command == "crawl":
        for r in frontier.counts(run_crawl(spark, a)).orderBy("status").collect():
            print(f"{r['status']:<16} {r['n']}")
    elif a.command == "dry-run":
        for r in decisions(root_links(spark, a.root, named(a.fetch)), a.root).orderBy("section", F.desc("allowed"), "url").toLocalIterator():
            print(f"{r['section']:<24} {'+' if r['allowed'] else '-'} {r['url']}")
    elif a.command == "export":
        card = export(
            read_records_in_order(spark, a.records), a.out, a.framework, a.schema, a.split_by, a.seed, a.min_answer_length, a.semantic_dedup, a.semantic_dedup_report,
            a.semantic_dedup_threshold, a.intent, single=not a.parts, splitter=a.splitter,
        )
        print(json.dumps(card, indent=2, ensure_ascii=False))
    elif a.command == "dataset-report":
        scored = open_snapshot(spark, a.frontier, frontier.COLUMNS).where("relevance_score is not null") if a.frontier else None
        print(reports.report_text(reports.dataset_report(read_records_in_order(spark, a.records), scored=scored)))
    elif a.command == "score-report":
        print(reports.score_report_text(open_snapshot(spark, a.frontier, frontier.COLUMNS)))
    elif a.embed:
        print(reports.results_text(query_text(spark, a.index, a.text, named(a.embed), a.embedding_model, a.k).collect()))
    else:
        print(reports.results_text(nearest(open_snapshot(spark, f"{a.index}/chunks", CHUNKS), json.loads(a.text), a.k).collect()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
