"""Training sets in the layouts of training frameworks."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut
from ..functions.text import slugs
from ..operators.records import BATCH_PROJECTIONS, PROJECTIONS, UNSUPPORTED, project
from ..operators.scope import derive_prefixes
from .records import write_array, write_json, write_lines, write_parts

SPLITS = ("train", "validation", "test")
FRAMEWORKS = ("mlx", "huggingface", "llama-factory", "axolotl", "plain-jsonl")
# Which schemas each framework reads, and how.
READS: Mapping[str, Mapping[str, str]] = {
    "mlx": {"conversational": "", "openai_finetune": "", "prompt_completion": ""},
    "llama-factory": {"alpaca": "alpaca", "conversational": "sharegpt", "openai_finetune": "sharegpt"},
    "axolotl": {"alpaca": "alpaca", "conversational": "chat_template", "openai_finetune": "chat_template"},
}


def check_target(framework: str, schema: str) -> None:
    """ValueError for an unknown framework or schema, or a schema that the framework cannot read."""
    if schema in UNSUPPORTED:
        raise ValueError(f"schema {schema!r} is not supported: {UNSUPPORTED[schema]}")
    if schema not in PROJECTIONS and schema not in BATCH_PROJECTIONS:
        raise ValueError(f"unknown schema {schema!r}")
    if framework not in FRAMEWORKS:
        raise ValueError(f"unknown framework {framework!r}; known: {list(FRAMEWORKS)}")
    if schema in PROJECTIONS and schema not in READS.get(framework, PROJECTIONS):
        raise ValueError(f"{framework} cannot read schema {schema!r}; it reads {sorted(READS[framework])}")


def _part(df: DataFrame, split: str, schema: str) -> DataFrame:
    return project(df.where(F.col("split") == split), schema)


def package(df: DataFrame, framework: str, schema: str, out: str, name: str = "canonical_export", single: bool = True) -> None:
    """Files of a framework from records with a ``split`` column, in the given order of rows.

    Without ``single`` each file becomes a folder of JSON lines that the tasks write
    themselves, in no order: nothing passes through the driver but the small descriptions.
    """
    check_target(framework, schema)
    if not single:
        _package_parts(df, framework, schema, out, name)
    elif framework in ("mlx", "huggingface"):
        for s in SPLITS:
            write_lines(_part(df, s, schema), os.path.join(out, f"{'valid' if framework == 'mlx' and s == 'validation' else s}.jsonl"))
    elif framework == "llama-factory":
        write_array(project(df, schema), os.path.join(out, f"{name}.json"))
        # The entry that the framework reads
        entry: dict = {"file_name": f"{name}.json"}
        if READS[framework][schema] == "sharegpt":
            entry |= {"formatting": "sharegpt", "columns": {"messages": "messages"}, "tags": {"role_tag": "role", "content_tag": "content", "user_tag": "user", "assistant_tag": "assistant"}}
        write_json({name: entry}, os.path.join(out, "dataset_info.json"))
    elif framework == "axolotl":
        path = os.path.join(out, "dataset.jsonl")
        write_lines(project(df, schema), path)
        with open(os.path.join(out, "axolotl_dataset.yaml"), "w", encoding="utf-8") as f:
            f.write(f"datasets:\n  - path: {path}\n    type: {READS[framework][schema]}\n")
    else:
        write_lines(project(df, schema), os.path.join(out, "unified.jsonl"))
        write_json(write_sections(df, schema, os.path.join(out, "sections")), os.path.join(out, "manifest.json"))


def _package_parts(df: DataFrame, framework: str, schema: str, out: str, name: str) -> None:
    if framework in ("mlx", "huggingface"):
        for s in SPLITS:
            write_parts(_part(df, s, schema), os.path.join(out, f"{'valid' if framework == 'mlx' and s == 'validation' else s}.jsonl"))
        return
    target = {"llama-factory": name, "axolotl": "dataset.jsonl"}.get(framework, "unified.jsonl")
    write_parts(project(df, schema), os.path.join(out, target))
    if framework == "plain-jsonl":
        listed = cut(manifest(df))
        marked = df.withColumn("section", F.coalesce("section", F.lit("root"))).join(listed.select("section", "slug"), "section")
        write_parts(marked.select("slug", *PROJECTIONS[schema]()), os.path.join(out, "sections"), "slug")
        write_parts(listed, os.path.join(out, "manifest"))


def manifest(df: DataFrame) -> DataFrame:
    """(slug, section, url_prefix, row_count) of each section; null sections are ``root``."""
    rows = df.select(F.coalesce("section", F.lit("root")).alias("section"), "source_url")
    prefix = derive_prefixes(rows.distinct(), "section", "source_url").select("section", F.concat(F.lit("https://"), "host", F.coalesce("prefix", F.lit("/"))).alias("url_prefix"))
    return rows.groupBy("section").agg(F.count("*").alias("row_count")).join(prefix, "section", "left").join(slugs(rows, "section"), "section")


def write_sections(df: DataFrame, schema: str, out: str) -> dict:
    """One JSON-lines file a section; the manifest. Rows are streamed once, sorted by slug, so any number of sections needs one open file."""
    import json

    listed = manifest(df)
    os.makedirs(out, exist_ok=True)
    body = F.to_json(F.struct(*PROJECTIONS[schema]())).alias("line")
    rows = df.withColumn("section", F.coalesce("section", F.lit("root"))).select("section", body).join(listed.select("section", "slug"), "section")
    current, f = None, None
    try:
        for r in rows.select("slug", "line").orderBy("slug").toLocalIterator():
            if r["slug"] != current:
                if f:
                    f.close()
                current, f = r["slug"], open(os.path.join(out, f"{r['slug']}.jsonl"), "w", encoding="utf-8")  # noqa: SIM115
            f.write(json.dumps(json.loads(r["line"]), ensure_ascii=False) + "\n")
    finally:
        if f:
            f.close()
    return {r["slug"]: {"url_prefix": r["url_prefix"], "row_count": r["row_count"]} for r in listed.orderBy("slug").toLocalIterator()}
