import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from siltworks.operators import chunks, frontier, near_dup, records, reports, scope

AT = "2025-01-01T00:00:00.000000+00:00"


def table(spark, rows):
    """Records with a column that clashes with internal names."""
    return spark.createDataFrame(rows, "record_seq long, question string, answer string, source_chunk string, source_url string, chunk_index int, section string").withColumn("ratio", F.lit("x")).withColumn("g", F.lit("x"))


def test_validate(spark):
    df = table(spark, [(1, "q", None, "", "u", 0, "s"), (2, "Same text that is long", "same TEXT that is long ", "", "u", 0, "s"), (3, "q", " short ", "", "u", 0, "s"), (4, None, "a long enough answer", "", "u", 0, "s"), (5, "q", " \n", "", "u", 0, "s")])
    ok, bad = records.validate(df)
    assert [r["record_seq"] for r in ok.collect()] == [4]
    assert {r["record_seq"]: r["_reject_reason"] for r in bad.collect()} == {1: "empty_answer", 2: "question_equals_answer", 3: "answer_too_short", 5: "empty_answer"}
    assert records.validate(df.limit(0))[0].count() == 0


def test_first_by_question(spark):
    rows = [(3, "What?", "a", "", "u", 0, "s"), (1, " what ", "b", "", "u", 0, "s"), (2, None, "c", "", "u", 0, "s"), (4, "", "d", "", "u", 0, "s"), (1, " what ", "b", "", "u", 0, "s")]
    got = records.dedup_by_question(table(spark, rows), [F.col("record_seq")])
    assert sorted(r["record_seq"] for r in got.collect()) == [1, 2]
    t = records.to_raw_text(table(spark, [(2, "", "", "A  b.", "u", 0, "s"), (1, "", "", "a b", "u", 0, "s"), (3, "", "", "", "u", 0, "s"), (4, "", "", None, "u", 0, "s")]), [F.col("record_seq")])
    assert [r["text"] for r in t.collect()] == ["a b"]


def test_splits(spark):
    rows = [(i, "q", "a", "c", f"u{i % 5}" if i % 7 else None, 0, "s") for i in range(40)]
    out = records.split_records(table(spark, rows), ratios=(0.8, 0.1, 0.1)).collect()
    by = {}
    for r in out:
        by.setdefault(r["source_url"], set()).add(r["split"])
    assert len(out) == 40 and all(len(v) == 1 for v in by.values())
    two = records.split_groups(table(spark, rows[:3])).collect()
    assert {r["split"] for r in two if r["grp"] != "unknown"} <= {"train", "validation", "test"}
    names = sorted({r[4] or "unknown" for r in rows})
    random.Random(42).shuffle(names)
    want = {n: "train" if i < round(len(names) * 0.8) else "validation" if i < round(len(names) * 0.8) + round(len(names) * 0.1) else "test" for i, n in enumerate(names)}
    assert {r["grp"]: r["split"] for r in records.split_groups(table(spark, rows)).collect()} == want
    big = spark.range(5000).select(F.col("id").cast("string").alias("source_url"))
    n = {r["split"]: r["count"] for r in records.hash_split(big).groupBy("split").count().collect()}
    assert abs(n["train"] / 5000 - 0.8) < 0.03


def test_projections(spark):
    df = table(spark, [(1, "q", "a", "c", "u", 0, "s")])
    one = lambda s: records.project(df, s).first().asDict(recursive=True)
    chat = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}
    assert one("conversational") == one("openai_finetune") == chat
    assert one("alpaca") == {"instruction": "q", "input": "", "output": "a"} and one("prompt_completion") == {"prompt": "q", "completion": "a"}
    assert one("embedding_pairs") == {"anchor": "q", "positive": "c"} and one("rag_eval") == {"question": "q", "ground_truth_answer": "a", "context": "c"}
    assert one("vertex") == {"contents": [{"role": "user", "parts": [{"text": "q"}]}, {"role": "model", "parts": [{"text": "a"}]}]}
    for s in ("dpo", "nothing"):
        with pytest.raises(ValueError):
            records.project(df, s)
    assert records.canonical(df).columns == list(records.FIELDS)


def test_triplets(spark):
    rows = [(i, f"q{i}", "a", f"c{i}", f"u{i % 4}", 0, "s") for i in range(60)]
    got = records.mine_triplets(table(spark, rows), [F.col("record_seq")]).collect()
    page = {f"c{i}": i % 4 for i in range(60)}
    assert len(got) == 60 and all(page[r["positive"]] != page[r["negative"]] for r in got)
    assert len({r["negative"] for r in got}) > 15
    assert records.mine_triplets(table(spark, rows[:1]), [F.col("record_seq")]).count() == 0


def ratio(a, b):
    n = lambda t: re.sub("[^a-z0-9 ]", "", (t or "").lower())
    return difflib.SequenceMatcher(None, n(b), n(a)).ratio()


def near_rows(seed):
    rnd = random.Random(seed)
    words = "the old lamp keeps nine quiet rivers under stone bridges while rain falls".split()
    rows = [(i, "q", " ".join(rnd.choice(words) for _ in range(rnd.randrange(9))) if i % 11 else None, f"c{rnd.randrange(4)}", f"u{i % 2}", rnd.choice([None, 0, 1, 2, 3]), "s") for i in range(40)]
    # copies of equal keys, interleaved, and texts whose ratio depends on the order
    rows += [(40 + k, "q", rnd.choice(rows)[2] if k % 3 else rnd.choice(["cbacbacbc", "bbcabbaba", "CBA cbacbc!", "bbcabbaba."]), f"c{k % 3}", f"u{k % 2}", k % 4, "s") for k in range(30)]
    return rows


def near_brute(rows, threshold):
    out = {}
    for x in range(len(rows)):
        for y in range(x + 1, len(rows)):
            r = ratio(rows[x][2], rows[y][2])
            if rows[x][4] == rows[y][4] and r >= threshold:
                out[(rows[x][0], rows[y][0])] = round(r, 9)
    return out


@pytest.mark.parametrize("block", [3, 128])
def test_near_duplicates_match_brute_force(spark, block):
    rows = near_rows(3)
    df = table(spark, rows)
    want = near_brute(rows, 0.5)
    got = near_dup.near_duplicates(df, "answer", 0.5, block=block).collect()
    assert len(got) == len(want) and {(r["i"], r["j"]): round(r["ratio"], 9) for r in got} == want
    links = near_dup.near_links(*near_dup.near_classes(df, "answer", 0.5, block=block)).collect()
    assert {r["s"]: r["links"] for r in links} == {r[0]: sum(r[0] in p for p in want) for r in rows}
    first = {}
    key = lambda t: re.sub("[^a-z0-9 ]", "", (t or "").lower())
    for r in rows:
        first.setdefault((r[4], key(r[2])), r)
    same = {r["record_seq"]: r["class_first"] for r in near_dup.duplicate_classes(df).collect()}
    assert all(same[r[0]] == first[(r[4], key(r[2]))][0] for r in rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_dedup_and_causes_match_brute_force(spark, seed):
    rows = near_rows(seed)
    df = table(spark, rows)
    pairs = near_brute(rows, 0.5)
    at = {r[0]: r for r in rows}
    lost, causes = {}, {}
    for (i, j), r in sorted(pairs.items()):
        w, x = (i, j) if len(at[i][2] or "") >= len(at[j][2] or "") else (j, i)
        if x not in lost or r > lost[x][1]:
            lost[x] = (w, r)
        c = "same_chunk" if at[i][3] == at[j][3] else "adjacent_chunk" if None not in (at[i][5], at[j][5]) and abs(at[i][5] - at[j][5]) == 1 else "other"
        causes[c] = causes.get(c, 0) + 1
    kept, why = near_dup.semantic_dedup(df, "answer", 0.5)
    assert {r["record_seq"]: (r["winner"], r["ratio"]) for r in why.collect()} == {x: (w, round(r, 3)) for x, (w, r) in lost.items()}
    assert {r["record_seq"] for r in kept.collect()} == set(at) - set(lost)
    members, classes = near_dup.near_classes(df, "answer", 0.5)
    assert {r["cause"]: r["pairs"] for r in reports.redundancy_of_classes(df, members, classes).collect()} == causes
    assert reports.redundancy_of_classes(df.limit(0), members.limit(0), classes.limit(0)).count() == 0


def test_semantic_dedup(spark):
    rows = [(1, "q", "the lamp keeps nine rivers", "c", "u", 0, "s"), (2, "q", "the lamp keeps nine rivers!", "c", "u", 1, "s"), (3, "q", "the lamp keeps ten rivers", "d", "u", 2, "s"), (4, "q", "else", "c", "u", 5, "s"), (5, "q", "the lamp keeps nine rivers", "c", "v", 0, "s")]
    kept, why = near_dup.semantic_dedup(table(spark, rows), "answer", 0.8)
    assert sorted(r["record_seq"] for r in kept.collect()) == [2, 4, 5]
    assert {r["record_seq"]: r["winner"] for r in why.collect()} == {1: 2, 3: 1} or {r["record_seq"] for r in why.collect()} == {1, 3}
    assert near_dup.semantic_dedup(table(spark, rows), "answer", 0.8, dry_run=True)[0].count() == 5
    pairs = near_dup.near_duplicates(table(spark, rows), "answer", 0.8)
    causes = {r["cause"]: r["pairs"] for r in reports.redundancy_by_cause(table(spark, rows), pairs).collect()}
    assert sum(causes.values()) == pairs.count()
    assert near_dup.near_duplicates(table(spark, rows).limit(0)).count() == 0
    r = reports.dataset_report(table(spark, rows))
    assert r["total"] == 5 and r["pages"] == 2 and reports.report_text(r).startswith("records: 5 on 2 pages")


def test_chunk_merge_and_upsert(spark):
    rows = [(1, "Text a.", "p1", "P1"), (2, "text  A", "p2", "P2"), (3, "other", "p1", "P1"), (4, "Text a.", "p1", "P9"), (5, None, "p", "P"), (6, "", None, "P")]
    df = spark.createDataFrame(rows, "chunk_no long, text string, source_url string, parent_text string").withColumn("sources", F.lit(1)).withColumn("ord", F.lit(1))
    m = chunks.merge_chunks(df, "text", "source_url", "parent_text", [F.col("chunk_no")])
    got = {r["text"]: (r["sources"], r["parent_text"]) for r in m.collect()}
    assert got == {"Text a.": (["p1", "p2"], "P1"), "other": (["p1"], "P1"), "": ([], "P")}
    calls = lambda texts: [[float(len(t))] for t in texts]
    old = chunks.embed_new(m.where("text = 'other'").withColumn("sources", F.array(F.lit("p0"))), None, calls)
    new = chunks.embed_new(m, old, lambda texts: [[-1.0]] * len(texts))
    both = {r["text"]: (r["sources"], list(r["embedding"])) for r in chunks.upsert_chunks(old, m.join(new.select("chunk_id", "embedding"), "chunk_id", "left")).collect()}
    assert both["other"] == (["p0", "p1"], [5.0]) and both["Text a."] == (["p1", "p2"], [-1.0])
    assert chunks.check_identity(None, "m", 3) == chunks.check_identity({"embedding_model": "m"}, "m", 3)
    with pytest.raises(ValueError):
        chunks.check_identity({"embedding_model": "m", "embedding_dim": 4}, "m", 3)


def test_nearest(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.randrange(4) / 1.0 for _ in range(3)] if i != 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    v = dict(rows)
    got = {}
    for r in chunks.nearest_to_all(df, df.where("vec_id % 10 = 0"), 4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: sorted((i for i in v if v[i]), key=lambda i: (d(v[q], v[i]), i))[:4] for q in v if q % 10 == 0}
    one = [r["vec_id"] for r in chunks.nearest(df, v[3], 5, key="vec_id").collect()]
    assert one == sorted((i for i in v if v[i]), key=lambda i: (d(v[3], v[i]), i))[:5]
    with pytest.raises(ValueError):
        chunks.nearest_to_all(df, df, max_queries=3)
    assert chunks.nearest_to_all(df, df.limit(0)).count() == 0


def test_units_and_page_scores(spark):
    df = spark.createDataFrame([("p", 0, [1.0, 0.0]), ("p", 1, [0.0, 1.0]), ("p", 2, [1.0, 0.0]), ("q", 0, [0.0, 0.0])], "page string, position int, v array<float>")
    got = [(r["page"], r["position"], r["chunk_index"]) for r in chunks.top_units(df, "page", "v", [1.0, 0.0], 2).orderBy("page", "chunk_index").collect()]
    assert got == [("p", 0, 0), ("p", 2, 1), ("q", 0, 0)]
    assert {r["page"]: r["score"] for r in chunks.page_scores(df, "page", "v", [1.0, 0.0]).collect()} == {"p": 1.0, "q": 0.0}


def test_scope(spark):
    df = spark.createDataFrame([("a", "https://h/t/x"), ("a", "https://h/t/x/y"), ("a", "https://h/t/x/z/q"), ("b", "https://h/t/leaf"), ("c", "https://h/p"), ("c", "https://h/q"), ("d", None), ("e", "https://h/")], "grp string, url string")
    got = {r["grp"]: (r["prefix"], r["degenerate"]) for r in scope.derive_prefixes(df, "grp", "url").collect()}
    assert got == {"a": ("/t/x/", False), "b": ("/t/", False), "c": (None, True), "e": (None, True)}
    u = spark.createDataFrame([("https://h/how-to",), ("https://h/how-to/x",), ("https://h/how-toz",), ("https://o/how-to",)], "url string")
    reason = scope.scope_reason(F.col("url"), F.lit("H"), F.lit("/how-to/"), F.col("url").endswith("/x"))
    assert [r[0] for r in u.select(reason).collect()] == ["accepted", "already_visited", "outside_prefix", "off_host"]
    seeds = spark.createDataFrame([("h", "/how-to/"), ("o", None)], "host string, prefix string")
    assert sorted(r[0] for r in scope.in_any_scope(u, "url", seeds).collect()) == ["https://h/how-to", "https://h/how-to/x", "https://o/how-to"]
    lab = {r["url"]: r["section_label"] for r in scope.sections(u, "url", seeds, 1).collect()}
    assert lab == {"https://h/how-to": "root", "https://h/how-to/x": "x", "https://h/how-toz": "how-toz", "https://o/how-to": "how-to"}
    b = {r["category"]: r["urls"] for r in scope.branches(u, "url", "h").collect()}
    assert b["External: o"] == ["https://o/how-to"] and len(b) == 3


def front(spark, rows):
    base = [(u, "h", d, None, p, s, sc, n, None, None, f"2025-01-01T00:00:{i:02d}.000000+00:00", AT) for i, (u, d, p, s, sc, n) in enumerate(rows)]
    return spark.createDataFrame(base, frontier.COLUMNS)


def test_frontier_transitions(spark):
    f = front(spark, [("a", 0, None, "queued", None, 0), ("b", 1, "a", "pending_score", None, 0), ("c", 1, "x", "pending_score", None, 0), ("d", 0, None, "in_progress", None, 2), ("e", 1, "d", "pending_score", None, 0)])
    f2 = frontier.seed(f, spark.createDataFrame([("a",), ("n",), ("n",), (None,)], "url string"), F.lit(AT))
    assert f2.count() == 6 and f2.where("url = 'n' and status = 'queued' and depth = 0").count() == 1
    kids = spark.createDataFrame([("k", "a", 0, "s"), ("k", "0", 0, "s"), ("b", "a", 0, "s"), ("deep", "q", 3, "s"), ("m", "b", 1, "s")], "url string, parent_url string, parent_depth int, section_label string")
    f3 = frontier.insert_children(f2, kids, F.lit(AT), max_depth=3)
    got = {r["url"]: (r["status"], r["depth"], r["parent_url"]) for r in f3.collect()}
    assert got["k"] == ("queued", 1, "0") and got["m"] == ("pending_score", 2, "b") and "deep" not in got and got["b"][0] == "pending_score"
    claimed = frontier.claimable(f3, F.lit(AT), 2)
    assert [r["url"] for r in claimed.collect()] == ["a", "k"]
    f4 = frontier.claim(f3, claimed, F.lit(AT))
    assert f4.where("status = 'in_progress'").count() == 3
    o = spark.createDataFrame([("a", "done", 0.7, None, None), ("n", "retry", None, "boom", "2025-02-01T00:00:00.000000+00:00"), ("d", "retry", None, "boom", None)], "url string, outcome string, score double, error string, not_before string")
    f5 = {r["url"]: r for r in frontier.resolve(f4, o, F.lit(AT), 0.5).collect()}
    assert f5["a"]["status"] == "done" and f5["b"]["status"] == "queued" and f5["n"]["status"] == "queued" and f5["n"]["retry_count"] == 1
    assert f5["d"]["status"] == "failed" and f5["e"]["status"] == "skipped_follow" and f5["c"]["status"] == "pending_score"
    late = spark.createDataFrame(list(f5.values()), frontier.COLUMNS)
    assert "n" not in {r["url"] for r in frontier.claimable(late, F.lit(AT)).collect()}
    q = frontier.quiescent(late).first()
    assert not q["over"] and q["stray"] == 1
    rec = {r["url"]: r["status"] for r in frontier.recover(f4, F.lit(AT)).collect()}
    assert rec["d"] == "failed" and rec["k"] == "queued" and rec["e"] == "skipped_follow"
    assert [r["url"] for r in frontier.scores(late).collect()] == ["a"] and frontier.in_progress(f4).count() == 3
    assert frontier.claimable(late, F.lit(AT), max_pages=1).count() == 0
    with pytest.raises(Exception, match="unknown status"):
        frontier.check(f.withColumn("status", F.lit("odd"))).collect()


def test_start_times(spark):
    df = spark.createDataFrame([("h", "a", 0.0), ("h", "b", 0.1), ("h", "c", 9.0), ("o", "d", 0.1)], "host string, url string, arrival double")
    got = {r["url"]: r["start"] for r in frontier.start_times(df, "host", "arrival", "url", F.lit(2.0)).collect()}
    assert got == {"a": 0.0, "b": 2.0, "c": 9.0, "d": 0.1}


def test_score_reports(spark):
    df = spark.createDataFrame([("a", 0.9, "done"), ("b", 0.5, "done"), ("c", 0.1, "done"), ("d", None, "queued")], "url string, relevance_score double, status string")
    got = {r["threshold"]: r["skipped"] for r in reports.threshold_sweep(df).collect()}
    assert got[0.5] == 1 and got[0.9] == 2 and got[0.1] == 0
    s = reports.score_stats(df).first()
    assert (s["n"], s["median"]) == (3, 0.5)
    assert "below 0.5: 1 of 3 (33%)" in reports.score_report_text(df)
    assert reports.score_report_text(df.limit(0)) == "no page has a score"
    assert reports.results_text([]) == "nothing found"


def test_start_times_match_the_recursion(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["h", "o", None]), f"u{k:03d}", float(rnd.randrange(0, 400)) / 4) for k in range(150)]
    last, want = {}, {}
    for h, u, a in sorted(rows, key=lambda r: (r[2], r[1])):
        last[h] = want[u] = max(last.get(h, float("-inf")) + 1.5, a)
    df = spark.createDataFrame(rows, "host string, url string, arrival double")
    for width in (7.0, 3600.0):
        got = frontier.start_times(df, "host", "arrival", "url", F.lit(1.5), width).collect()
        assert {r["url"]: round(r["start"], 9) for r in got} == {u: round(x, 9) for u, x in want.items()}
    with pytest.raises(ValueError):
        frontier.start_times(df, "host", "arrival", "url", F.lit(1.5), 0)
