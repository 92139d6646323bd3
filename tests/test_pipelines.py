import json

import pytest
from pyspark.sql import functions as F

from siltworks.operators import frontier
from siltworks.plans import crawl, export
from siltworks.sources import fetch, packaging, records
from siltworks.streaming import pipeline


def write(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def grid():
    rows = [{"question": f"Question {s} {i}?", "answer": f"A long enough answer number {s} {i}", "source_chunk": f"chunk {s} {i}", "source_url": f"https://x.com/section{s}/page{i}", "section": f"section{s}", "generation_model": "m", "crawl_date": "2026-01-01", "license_signal": "MIT" if s == 1 else None} for s in range(3) for i in range(4)]
    return [*rows, rows[0] | {"answer": "The second answer to a known question"}, rows[1] | {"question": "Empty?", "answer": ""}]


@pytest.mark.parametrize("framework,files", [("mlx", {"train.jsonl", "valid.jsonl", "test.jsonl"}), ("huggingface", {"train.jsonl", "validation.jsonl", "test.jsonl"}), ("axolotl", {"dataset.jsonl", "axolotl_dataset.yaml"}), ("plain-jsonl", {"unified.jsonl", "manifest.json", "sections"}), ("llama-factory", {"canonical_export.json", "dataset_info.json"})])
def test_export(spark, tmp_path, framework, files):
    raw = records.read_records_in_order(spark, write(tmp_path / "in.jsonl", grid()))
    card = export.export(raw, str(tmp_path / "out"), framework, "conversational")
    assert card["row_counts"] == {"raw_canonical_records": 14, "valid_after_validation": 13, "rejected_by_validation": 1, "removed_by_dedup": 1, "removed_by_semantic_dedup": 0, "final": 12}
    assert card["sites"] == ["x.com"] and card["license_signals_observed"] == ["MIT"] and card["generation_model"] == "m"
    assert {p.name for p in (tmp_path / "out").iterdir()} == files | {"dataset_card.json"}
    if framework == "plain-jsonl":
        m = json.loads((tmp_path / "out/manifest.json").read_text())
        assert m["section1"] == {"url_prefix": "https://x.com/section1/", "row_count": 4}
        assert len((tmp_path / "out/sections/section2.jsonl").read_text().splitlines()) == 4
    if framework == "llama-factory":
        assert len(json.loads((tmp_path / "out/canonical_export.json").read_text())) == 12
    if framework == "huggingface":
        lines = [json.loads(x) for p in files for x in (tmp_path / "out" / p).read_text().splitlines()]
        assert len(lines) == 12 and lines[0]["messages"][0]["role"] == "user"


def test_batch_schemas_reports_and_guards(spark, tmp_path):
    raw = records.read_records_in_order(spark, write(tmp_path / "in.jsonl", grid()))
    card = export.export(raw, str(tmp_path / "t"), schema="triplets", near_dedup=False, near_report=True, threshold=0.9)
    report = json.loads((tmp_path / "t/semantic_dedup_report.json").read_text())
    assert not report["applied"] and report["candidate_count"] == len(report["candidates"]) and card["row_counts"]["removed_by_semantic_dedup"] == 0
    assert (tmp_path / "t/train.jsonl").read_text()
    export.export(raw, str(tmp_path / "r"), schema="raw_text")
    assert json.loads((tmp_path / "r/train.jsonl").read_text().splitlines()[0])["text"].startswith("chunk")
    for f, s in (("mlx", "alpaca"), ("nobody", "alpaca"), ("mlx", "dpo"), ("axolotl", "vertex"), ("mlx", "what")):
        with pytest.raises(ValueError):
            packaging.check_target(f, s)


def test_readers(spark, tmp_path):
    good = write(tmp_path / "g.jsonl", [{"source_url": "u", "question": "q"}])
    assert records.read_records(spark, good).count() == 1
    (tmp_path / "b.jsonl").write_text('{"source_url": "u"}\n\n{broken\n{"source_url": null}\n{"source_url": "v"}\n')
    assert {r[0] for r in records.written_urls(spark, str(tmp_path / "b.jsonl")).collect()} == {"u", "v"}
    assert records.written_urls(spark, str(tmp_path / "missing")).count() == 0
    with pytest.raises(Exception):  # noqa: B017
        records.read_records(spark, str(tmp_path / "b.jsonl")).collect()


def site():
    """A fetch function of a small site; made here so that it travels by value."""
    links = {"a": "bc", "b": "de", "c": "fg", "d": "h", "e": "", "f": "", "g": "", "h": ""}

    def page_of(url):
        name = url.rsplit("/", 1)[1]
        if name == "g":
            error = RuntimeError("gone")
            error.status = 404
            raise error
        return f"<main><h1>{name}</h1>" + "".join(f"<a href='/s/{k}'>{k}</a>" for k in links[name]) + "<a href='https://other/x'>o</a></main>"

    return page_of


def test_crawl_by_waves(spark):
    seeds = spark.createDataFrame([("https://h/s/a",)], "url string")
    scopes = spark.createDataFrame([("h", "/s/")], "host string, prefix string")
    seen = []
    clock = lambda k: F.lit(f"2025-01-01T00:{k:02d}:00.000000+00:00")
    front = crawl.crawl(spark, seeds, site(), scopes, clock, waves=12, on_pages=lambda p, k: seen.extend(r["url"][-1] for r in p.collect()))
    got = {r["url"][-1]: (r["status"], r["depth"]) for r in front.collect()}
    assert {k: v[0] for k, v in got.items()} == {**dict.fromkeys("abcdefh", "done"), "g": "failed"}
    assert got["h"][1] == 3 and sorted(seen) == list("abcdefh")
    assert frontier.quiescent(front).first()["over"]
    gated = crawl.crawl(spark, seeds, site(), scopes, clock, waves=8, score=lambda p: p.withColumn("score", F.when(F.col("url").endswith("/b"), 0.1).otherwise(0.9)), follow_threshold=0.5, extract_threshold=0.5)
    got = {r["url"][-1]: r["status"] for r in gated.collect()}
    assert got["b"] == "skipped_extract" and got["d"] == got["e"] == "skipped_follow" and got["c"] == got["f"] == "done"


def test_extraction(spark):
    pages = spark.createDataFrame([("u", "# T\n\nfirst part\n\nsecond part", "s"), ("v", "bad", "s"), ("w", "", "s")], "url string, markdown string, section string")

    def make():
        return lambda t: "no list" if t == "bad" else json.dumps([{"instruction": "q " + t[-6:], "response": "r"}])

    recs, out = crawl.extract_records(pages, make, "m", F.lit("2025-01-01T00:00:00+00:00"), size=14, overlap=0)
    assert {r["url"]: r["outcome"] for r in out.collect()} == {"u": "done", "v": "retry", "w": "done"}
    got = recs.orderBy("chunk_index").collect()
    assert len(got) >= 2 and {r["page_title"] for r in got} == {"T"} and got[0]["crawl_date"] == "2025-01-01"
    with pytest.raises(ValueError):
        crawl.extract_records(pages, make, "m", F.lit(""), strategy="odd")


def test_policies_and_fetch(spark):
    hosts = spark.createDataFrame([("h",), ("h",), ("o",), (None,)], "host string")

    def get(url):
        if url.startswith("https://o"):
            raise OSError("down")
        return "User-agent: *\nDisallow: /x" if url.endswith("robots.txt") else "<?xml version='1.0'?>\n<!-- x -->\n<urlset xmlns='y'/>" if url.endswith("sitemap.xml") else None

    got = {r["host"]: r for r in crawl.policies(spark, hosts, get).collect()}
    assert got["h"]["robots_found"] and not got["h"]["llms_found"] and not got["o"]["robots_found"] and len(got["h"]["rules"]) == 1
    assert (got["h"]["sitemap_found"], got["h"]["sitemap_root_tag"], got["o"]["sitemap_found"], got["h"]["llms"]) == (True, "urlset", False, None)

    def page(url):
        e = RuntimeError("slow down")
        e.status = 429
        raise e

    r = fetch.fetch_pages(spark.createDataFrame([("u",)], "url string"), page).first()
    assert (r["outcome"], r["retry_after"]) == ("retry", 5.0)


def test_stream_writes_each_page_once(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    page = spark.createDataFrame([("u", "<p>x</p>"), ("v", "<p>y</p>")], "url string, html string").withColumn("fetched_at", F.current_timestamp())
    page.write.mode("append").parquet(src)
    make = lambda b: b.select(F.col("url").alias("source_url"), F.col("html").alias("question"))
    sizes = []
    for extra in (None, [("u", "<p>again</p>"), ("w", "<p>z</p>")]):
        if extra:
            spark.createDataFrame(extra, "url string, html string").withColumn("fetched_at", F.current_timestamp()).write.mode("append").parquet(src)
        q = pipeline.run(pipeline.page_stream(spark, src), make, sink, str(tmp_path / "ck"), also=lambda d, n: sizes.append(d.count()))
        q.awaitTermination(60)
    rows = spark.read.json(sink).collect()
    assert sorted(r["source_url"] for r in rows) == ["u", "v", "w"] and sizes == [2, 1]


def test_stream_of_spaced_requests(spark, tmp_path):
    src = str(tmp_path / "req")
    spark.createDataFrame([("h", "a", 0.0), ("h", "b", 0.1), ("o", "c", 0.2)], "host string, url string, arrival double").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("host string, url string, arrival double").parquet(src)
    q = pipeline.spaced(stream, 1.0).writeStream.format("memory").queryName("starts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(90)
    assert {r["url"]: r["start"] for r in spark.table("starts").collect()} == {"a": 0.0, "b": 1.0, "c": 0.2}
    assert pipeline.rates(spark.createDataFrame([("done",), ("queued",)], "status string"), 30).first()["pages_per_minute"] == 2.0


def counted(folder, fails):
    """A fetch function that raises 429 for the first ``fails`` calls of a url, counted in files, since tasks share nothing else."""

    def page_of(url):
        import os
        import uuid

        name = url.rsplit("/", 1)[1]
        open(os.path.join(folder, f"{name}-{uuid.uuid4().hex}"), "w").close()
        if sum(f.startswith(name + "-") for f in os.listdir(folder)) <= fails:
            error = RuntimeError("slow down")
            error.status = 429
            raise error
        return f"<main><h1>{name}</h1><p>text</p></main>"

    return page_of


def second(k):
    return F.lit(f"2025-01-01T00:{k // 60:02d}:{k % 60:02d}.000000+00:00")


def test_crawl_waits_for_delayed_retries(spark, tmp_path):
    seeds, scopes = spark.createDataFrame([("https://h/s/a",)], "url string"), spark.createDataFrame([("h", "/s/")], "host string, prefix string")
    waits = []
    front = crawl.crawl(spark, seeds, counted(str(tmp_path), 1), scopes, second, wait=waits.append).first()
    assert (front["status"], front["retry_count"]) == ("done", 1) and waits and waits[0] == 4.0 and max(waits) <= 5.0
    (tmp_path / "x").mkdir()
    front = crawl.crawl(spark, seeds, counted(str(tmp_path / "x"), 9), scopes, second, wait=waits.append).first()
    assert (front["status"], front["retry_count"]) == ("failed", 3)


def test_crawl_resumes_from_its_store(spark, tmp_path):
    from siltworks.sources.snapshots import open_snapshot, save_snapshot, versions

    store = str(tmp_path / "front")
    seeds, scopes = spark.createDataFrame([("https://h/s/a",)], "url string"), spark.createDataFrame([("h", "/s/")], "host string, prefix string")
    first = crawl.crawl(spark, seeds, site(), scopes, second, waves=1, store=store)
    assert {r["status"] for r in first.collect()} == {"done", "queued"}
    # a crash in the second wave: its claim was written, its outcome was not
    claimed = frontier.claim(first, frontier.claimable(first, second(5)), second(5))
    save_snapshot(claimed, store)
    (tmp_path / "front" / "v99999999").mkdir()
    assert versions(spark, store)[-1] < 99999999
    seen = []
    last = crawl.crawl(spark, seeds, site(), scopes, lambda k: second(k + 10), store=store, on_pages=lambda p, k: seen.extend(r["url"][-1] for r in p.collect()))
    got = {r["url"][-1]: (r["status"], r["retry_count"]) for r in last.collect()}
    assert {k: v[0] for k, v in got.items()} == {**dict.fromkeys("abcdefh", "done"), "g": "failed"}
    assert "a" not in seen and got["b"][1] == 1 and got["a"][1] == 0
    assert sorted(map(str, open_snapshot(spark, store, frontier.COLUMNS).collect())) == sorted(map(str, last.collect()))
    assert open_snapshot(spark, str(tmp_path / "none"), "a int").count() == 0


def test_crawl_extracts_and_writes_before_done(spark, tmp_path):
    seeds, scopes = spark.createDataFrame([("https://h/s/b",)], "url string"), spark.createDataFrame([("h", "/s/")], "host string, prefix string")
    make = lambda: lambda t: "no list" if "# d" in t else json.dumps([{"instruction": "q", "response": t}])
    extract = lambda p: crawl.extract_records(p, make, "m", F.lit("2025-01-01T00:00:00+00:00"))
    sink = str(tmp_path / "sink")
    front = crawl.crawl(spark, seeds, site(), scopes, second, extract=extract, write=lambda r: records.append_new_pages(spark, r, sink))
    got = {r["url"][-1]: (r["status"], r["retry_count"]) for r in front.collect()}
    # d never parses: tried three times, then failed; its child was released by its score at once
    assert got == {"b": ("done", 0), "d": ("failed", 3), "e": ("done", 0), "h": ("done", 0)}
    assert sorted(r["source_url"][-1] for r in spark.read.json(sink).collect()) == ["b", "e", "h"]


def test_heading_scores_and_top_units(spark):
    embed = lambda texts: [[float(t.count("lamp")), float(t.count("vault"))] for t in texts]
    rows = [("u", "# lamp\n\nvault vault vault"), ("v", "vault only"), ("w", None)]
    df = spark.createDataFrame(rows, "url string, markdown string")
    got = {r["url"]: round(r["score"], 3) for r in fetch.heading_scores(df, "markdown", embed, [1.0, 0.0]).collect()}
    assert got == {"u": 1.0, "v": 0.0, "w": 0.0}
    assert {r["score"] for r in fetch.score_by(embed, None)(df).collect()} == {1.0}
    assert {r["url"]: r["score"] for r in fetch.score_by(embed, "lamp")(df).collect()}["u"] == 1.0
    pages = spark.createDataFrame([("u", "vault one\n\nlamp two lamp\n\nlamp vault three"), ("v", "")], "url string, markdown string")
    top = crawl.extraction_units(pages, crawl.TOP_CHUNKS, size=18, overlap=0, embed=embed, intent=[1.0, 0.0], k=2).orderBy("url", "chunk_index").collect()
    assert [(r["url"], r["chunk_index"], r["source_chunk"]) for r in top] == [("u", 0, "lamp two lamp"), ("u", 1, "lamp vault three"), ("v", None, None)]
    every = crawl.extraction_units(pages, crawl.TOP_CHUNKS, size=18, overlap=0).where("source_chunk is not null")
    assert every.count() == 3
    assert crawl.extraction_units(pages, crawl.FIRST_CHARS, longest=5).where("url = 'u'").first()["source_chunk"] == "vault"


def embedding():
    """Counts as vectors; made here so that it travels by value."""
    return lambda texts: [[float(t.count("lamp")), float(len(t))] for t in texts]


def test_chunk_index_is_stored_with_its_identity(spark, tmp_path):
    from siltworks.sources import chunk_index

    path, lamp_embed = str(tmp_path / "index"), embedding()
    chunks = lambda rows: spark.createDataFrame(rows, "chunk_id string, text string, sources array<string>, parent_text string")
    assert chunk_index.identity(spark, path) is None and chunk_index.open_index(spark, path, "m", 2).count() == 0
    chunk_index.upsert(chunks([("1", "lamp lamp", ["u"], "p"), ("2", "vault", ["u"], "p")]), path, lamp_embed, "m", 2)
    calls = str(tmp_path / "calls")

    def noted(texts):
        with open(calls, "a") as f:
            f.write("".join(t + "\n" for t in texts))
        return lamp_embed(texts)

    chunk_index.upsert(chunks([("1", "lamp lamp", ["v"], "other"), ("3", "river lamp", ["v"], "q")]), path, noted, "m", 2)
    got = {r["chunk_id"]: r for r in chunk_index.open_index(spark, path, "m", 2).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"]["sources"] == ["u", "v"] and got["1"]["parent_text"] == "p" and got["1"]["embedding"][0] == 2.0
    assert open(calls).read() == "river lamp\n"
    for model, dim in (("other", 2), ("m", 3)):
        with pytest.raises(ValueError):
            chunk_index.open_index(spark, path, model, dim)
    near = chunk_index.query_text(spark, path, "lamp lamp", lamp_embed, "m", 2).collect()
    assert [r["chunk_id"] for r in near] == ["1", "3"] and near[0]["distance"] == 0.0
    assert chunk_index.query_text(spark, str(tmp_path / "none"), "x", lamp_embed, "m").count() == 0


def test_sink_lists_its_urls_beside_it(spark, tmp_path):
    sink = str(tmp_path / "sink")
    batch = lambda rows: spark.createDataFrame(rows, "source_url string, question string")
    assert records.append_new_pages(spark, batch([("u", "1"), ("u", "2"), (None, "3")]), sink).count() == 3
    assert records.append_new_pages(spark, batch([("u", "1"), ("v", "4")]), sink).count() == 1
    # a file that was written but not listed, as after a crash
    batch([("w", "5")]).write.mode("append").json(sink)
    done = []
    assert records.write_batch(spark, batch([("v", "4"), ("w", "5"), ("x", "6")]), sink, batch([("a", "b")]), done.append).count() == 1 and len(done) == 1
    assert {r[0] for r in records.known_urls(spark, sink).collect()} == {"u", "v", "w", "x"}
    assert records.known_urls(spark, str(tmp_path / "none")).count() == 0


def test_export_in_parts(spark, tmp_path):
    raw = records.read_records_in_order(spark, write(tmp_path / "in.jsonl", [*grid(), grid()[0] | {"question": "Asked otherwise?", "answer": "A long enough answer number 0 0 again"}]))
    out = tmp_path / "out"
    card = export.export(raw, str(out), "plain-jsonl", near_report=True, threshold=0.9, single=False, splitter="hash")
    assert card["row_counts"]["final"] == 13
    assert spark.read.json(str(out / "unified.jsonl")).count() == 13
    assert {r["slug"]: r["count"] for r in spark.read.json(str(out / "sections")).groupBy("slug").count().collect()} == {"section0": 5, "section1": 4, "section2": 4}
    assert {r["slug"]: (r["url_prefix"], r["row_count"]) for r in spark.read.json(str(out / "manifest")).collect()}["section1"] == ("https://x.com/section1/", 4)
    assert spark.read.json(str(out / "dataset_card")).first()["row_counts"]["final"] == 13
    n = spark.read.json(str(out / "semantic_dedup_report")).first()["candidate_count"]
    listed = spark.read.json(str(out / "semantic_dedup_candidates")).collect()
    assert len(listed) == n > 0 and {r["reason"] for r in listed} == {"semantic_near_duplicate"} and all(r["record"]["question"] and r["kept_question"] for r in listed)
    export.export(raw, str(tmp_path / "m"), "mlx", single=False)
    assert sum(spark.read.json(str(tmp_path / "m" / f"{s}.jsonl")).count() for s in ("train", "valid", "test") if any((tmp_path / "m" / f"{s}.jsonl").glob("*.json"))) == 13
    with pytest.raises(ValueError):
        export.export(raw, str(out), splitter="odd")


LAMPS = """
import json

def docs_site(url):
    pages = {"https://h": "<a href='/docs/a'>a</a><a href='/docs/b'>b</a><a href='/blog/x'>x</a><a href='mailto:m'>m</a><a href='https://o/z'>z</a>", "https://h/docs/a": "<h1>lamp</h1><p>The lamp keeps it.</p><a href='/docs/c'>c</a>"}
    if url.endswith(".txt"):
        raise OSError("none")
    return f"<main>{pages.get(url, '<h1>page</h1><p>text of ' + url + '</p>')}</main>"

def answer():
    return lambda text: json.dumps([{"instruction": "q", "response": text}])

def lamp_embed(texts):
    return [[float(t.count("lamp")), float(len(t))] for t in texts]
"""


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from siltworks import __main__ as cli

    (tmp_path / "lamps.py").write_text(LAMPS)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "lamps.py"))
    cli.main(["dry-run", "https://h", "--fetch", "lamps:docs_site"])
    told = capsys.readouterr().out.splitlines()
    assert any(x.split() == ["Path:", "/docs/*", "+", "https://h/docs/b"] for x in told) and any(x.split() == ["Path:", "/docs/*", "-", "https://h/blog/x"] for x in told)
    out = str(tmp_path / "c")
    for _ in range(2):
        cli.main(["crawl", "https://h", out, "--branch", "Path: /docs/*", "--fetch", "lamps:docs_site", "--ask", "lamps:answer", "--embed", "lamps:lamp_embed", "--embedding-model", "m", "--intent", "lamp"])
        assert capsys.readouterr().out.split() == ["done", "3"]
    assert {r["source_url"] for r in spark.read.json(f"{out}/records").collect()} == {f"https://h/docs/{k}" for k in "abc"}
    cli.main(["score-report", f"{out}/frontier"])
    assert capsys.readouterr().out.startswith("3 scored pages")
    cli.main(["query", f"{out}/index", "lamp", "--embed", "lamps:lamp_embed", "--embedding-model", "m", "-k", "1"])
    assert "distance" in capsys.readouterr().out


def test_requests_of_one_host_keep_their_distance(spark, tmp_path):
    folder = str(tmp_path)

    def noted(url):
        import os
        import time
        import uuid

        start = time.time()
        time.sleep(0.02)
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(f"{url} {start} {time.time()}")
        return "x"

    urls = spark.createDataFrame([(f"https://h/{k}",) for k in range(8)] + [("https://o/1",)], "url string")
    got = fetch.fetch_pages(urls, noted, per_host=2, delay=0.05).collect()
    assert len(got) == 9 and all(r["html"] == "x" for r in got)
    calls = sorted(((float(a), float(b)) for u, a, b in (p.read_text().split() for p in tmp_path.iterdir()) if u.startswith("https://h/")))
    assert max(sum(a <= x < b for a, b in calls) for x, _ in calls) <= 2
    assert calls[-1][0] - calls[0][0] >= 3 * 0.1 - 0.02
    with pytest.raises(ValueError):
        fetch.fetch_pages(urls, noted, per_host=-1)


def test_progress(spark):
    rows = [("a", "done", "2"), ("b", "in_progress", "3"), ("c", "in_progress", "1"), ("d", "failed", "1"), ("e", "pending_score", "1")]
    text = pipeline.progress_text(spark.createDataFrame(rows, "url string, status string, updated_at string"), 60)
    assert text.splitlines() == ["1 pages done, 1.00 a minute, 2 at work, 0 queued, 1 waiting, 0 skipped, 1 failed", "  b", "  c"]
    assert pipeline.progress_text(spark.createDataFrame([], "url string, status string, updated_at string"), 0).startswith("0 pages")
