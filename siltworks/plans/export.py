"""Canonical records to a packaged training set: validate, dedup, near-dedup, split, project, package."""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut
from ..operators import records as R
from ..operators.near_dup import ANSWER_THRESHOLD, semantic_dedup
from ..sources.packaging import check_target, package
from ..sources.records import write_json, write_lines, write_parts


def dataset_card(raw: DataFrame, valid: int, rejected: int, removed: int, near_removed: int = 0, intent: str | None = None, generation_model: str = "unknown", least: int = 20) -> DataFrame:
    """One row: sites, crawl dates and licence signals of the raw records, and the row counts."""
    site = F.nullif(F.regexp_extract("source_url", "^[^/]*//([^/]*)", 1), F.lit(""))
    seen = lambda c: F.sort_array(F.collect_set(F.nullif(c, F.lit(""))))
    return raw.agg(seen(site).alias("sites"), seen(F.col("crawl_date")).alias("crawl_dates"), seen(F.col("license_signal")).alias("licences")).select(
        "sites", "crawl_dates", F.lit(intent).cast("string").alias("intent"), F.lit(generation_model).alias("generation_model"),
        F.struct(
            F.lit(valid + rejected).alias("raw_canonical_records"), F.lit(valid).alias("valid_after_validation"), F.lit(rejected).alias("rejected_by_validation"),
            F.lit(removed).alias("removed_by_dedup"), F.lit(near_removed).alias("removed_by_semantic_dedup"), F.lit(valid - removed - near_removed).alias("final"),
        ).alias("row_counts"),
        F.lit(least).alias("validation_min_answer_length"),
        F.when(F.size("licences") > 0, F.col("licences")).alias("license_signals_observed"),
        F.lit(datetime.now(timezone.utc).isoformat()).alias("generated_at"),
    )


def export(raw: DataFrame, out: str, framework: str = "plain-jsonl", schema: str = "conversational", split_by: str = "section", seed: int = 42, least: int = 20, near_dedup: bool = False, near_report: bool = False, threshold: float = ANSWER_THRESHOLD, intent: str | None = None, seq: str = "record_seq", single: bool = True, splitter: str = "seeded") -> dict:
    """Run an export of records with ``seq``; returns the card. Batch schemas ignore the framework and run per split.

    ``single`` writes files of fixed names on the driver's file system, in order; without it the tasks
    write folders. ``splitter`` is ``seeded`` (a shuffle of all group names in one place) or
    ``hash`` (no driver, shares in expectation).
    """
    check_target(framework, schema)
    if splitter not in ("seeded", "hash"):
        raise ValueError(f"unknown splitter {splitter!r}")
    marked = cut(R.with_reasons(raw, least))
    n = {r["ok"]: r["count"] for r in marked.groupBy(F.col("_reject_reason").isNull().alias("ok")).count().collect()}
    valid = marked.where("_reject_reason is null").drop("_reject_reason")
    kept = cut(R.dedup_by_question(valid, [F.col(seq)]))
    removed = n.get(True, 0) - kept.count()
    near_removed = 0
    if near_dedup or near_report:
        survivors, reasons = semantic_dedup(kept, "answer", threshold, seq, dry_run=not near_dedup)
        reasons = cut(reasons)
        if near_report:
            text = kept.select(F.col(seq).alias("winner"), F.col("question").alias("kept_question"))
            whole = F.struct(*[c for c in kept.columns if c != seq])
            listed = reasons.join(text, "winner").join(kept.select(seq, whole.alias("record")), seq)
            listed = listed.select(seq, "record", F.lit("semantic_near_duplicate").alias("reason"), "ratio", "kept_question")
            head = {"threshold": threshold, "applied": near_dedup, "candidate_count": reasons.count()}
            if single:
                rows = [r["record"].asDict(recursive=True) | {"reason": r["reason"], "ratio": r["ratio"], "kept_question": r["kept_question"]} for r in listed.orderBy(seq).toLocalIterator()]
                write_json(head | {"candidates": rows}, os.path.join(out, "semantic_dedup_report.json"))
            else:
                write_parts(listed.drop(seq), os.path.join(out, "semantic_dedup_candidates"))
                write_parts(kept.sparkSession.createDataFrame([tuple(head.values())], "threshold double, applied boolean, candidate_count long"), os.path.join(out, "semantic_dedup_report"))
        if near_dedup:
            kept, near_removed = survivors, reasons.count()
    first = kept.orderBy(seq).select("generation_model").first()
    cards = cut(dataset_card(raw, n.get(True, 0), n.get(False, 0), removed, near_removed, intent, first[0] if first else "unknown", least))
    card = cards.first().asDict(recursive=True)
    split = cut(R.hash_split(kept, split_by, seed=seed) if splitter == "hash" else R.split_records(kept, split_by, seed=seed))
    if single:
        split = split.orderBy(seq)
    if schema in R.BATCH_PROJECTIONS:
        for s in ("train", "validation", "test"):
            part = split.where(F.col("split") == s)
            rows = R.to_raw_text(part, [F.col(seq)]) if schema == "raw_text" else R.mine_triplets(part, [F.col(seq)], seed)
            (write_lines if single else write_parts)(rows, os.path.join(out, f"{s}.jsonl"))
    else:
        package(split, framework, schema, out, single=single)
    if single:
        write_json(card, os.path.join(out, "dataset_card.json"))
    else:
        write_parts(cards, os.path.join(out, "dataset_card"))
    return card
