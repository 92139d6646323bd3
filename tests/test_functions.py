import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from siltworks.functions import html, qajson, robots, splitter, text, urls, vectors


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normal_urls(spark):
    got = col(spark, [" HTTPS://A.Example/x/y//?b=2&a=1#f\n", "http://h", "https://h/?q=", "mailto:x", "", None, "/rel", "HTTP://h/Ab/#t", "https:///x", "http://h/a b"], urls.normal_url)
    assert got == ["https://a.example/x/y?a=1&b=2", "http://h/", "https://h/?q=", None, None, None, None, "http://h/Ab", None, "http://h/a b"]


def test_native_and_resolved_forms_agree(spark):
    rnd = random.Random(7)
    part = lambda s, n: "".join(rnd.choice(s) for _ in range(rnd.randrange(n)))
    urls_ = [f"{rnd.choice(['http', 'HTTPS'])}://{part('aB.', 5)}x.y/{part('aZ1/-_', 9)}{'?' + '&'.join(f'{part('ab', 3)}k={part('12', 3)}' for _ in range(3)) if rnd.random() < 0.5 else ''}{'#f' if rnd.random() < 0.3 else ''}" for _ in range(300)]
    df = spark.createDataFrame([(u,) for u in urls_], "u string")
    assert df.where(~urls.normal_url(F.col("u")).eqNullSafe(urls.resolve_url(F.col("u"), F.lit("")))).count() == 0


def test_resolve_odd_links(spark):
    df = spark.createDataFrame([("../b?x=1#t", "https://h/a/c/d"), ("//o.h/p/", "https://h/"), ("javascript:x", "https://h/"), (None, "https://h"), (" ", "https://h"), ("http://[bad", "https://h"), ("a", None)], "h string, b string")
    assert [r[0] for r in df.select(urls.resolve_url("h", "b")).collect()] == ["https://h/a/b?x=1", "https://o.h/p", None, None, None, None, None]


def test_url_parts(spark):
    v = ["https://h:8/a/b/c?q=1", "https://h/", "https://h", None]
    assert col(spark, v, urls.host) == ["h:8", "h", "h", None]
    assert col(spark, v, urls.path) == ["/a/b/c", "/", "/", None]
    assert col(spark, v[:3], urls.section) == ["a/b", "root", "root"]
    assert col(spark, ["https://h/a/b", "https://o/x", "https://h/"], lambda c: urls.branch(c, "H")) == ["Path: /a/*", "External: o", "Root Level"]
    assert col(spark, [" /A/b/ ", "Unknown", "ROOT", " ", None, "x"], urls.named_section) == ["a/b", None, None, None, None, "x"]
    with pytest.raises(ValueError):
        urls.section(F.lit("x"), 0)


def test_chunk_ids(spark):
    v = ["  Two   words.\n", "two words!?", "", None, "a b", "..."]
    keys = [None if x is None else re.sub(r"\s+", " ", x).strip().lower().rstrip(".,;:!?") for x in v]
    assert col(spark, v, text.chunk_key) == keys
    assert col(spark, v, text.chunk_id) == [None if k is None else hashlib.sha256(k.encode()).hexdigest() for k in keys]
    assert col(spark, ["Ünï Code 9!", None], text.near_key) == ["n code 9", ""]


def test_slugs(spark):
    long = "x" * 70
    assert col(spark, ["A b!", "--", "con", long], text.slug) == ["a-b", "root", "con-section", "x" * 51 + "-" + hashlib.sha256(long.encode()).hexdigest()[:8]]
    df = spark.createDataFrame([("a!b",), ("a?b",), ("a.b",), ("a b 1",), (None,), ("a!b",)], "section string").withColumn("slug", F.lit(1))
    got = {r["section"]: r["slug"] for r in text.slugs(df).collect()}
    assert got["a!b"] == "a-b" and len(set(got.values())) == 4 and got["a b 1"] == "a-b-1"


def test_titles_and_licences(spark):
    assert col(spark, ["x\n# Head [|](u)\n# Two", "no", "#  \n", None, "## not"], text.page_title) == ["Head", None, None, None, None]
    assert col(spark, ["under CC BY-SA 4.0 or MIT License", "ALL rights reserved. Apache License, version 2.0", "© 2020 Me\nx", "none", None], text.licence_signal) == ["CC BY-SA 4.0", "Apache License, version 2.0", "© 2020 Me", None, None]
    assert col(spark, [" # a\nb\n## c", "", None], text.headings) == ["# a\n## c", "", None]


LINK = re.compile(r'(!?)\[((?:[^\[\]]|\[[^\[\]]*\])*)\]\([^)\s]+(?:\s+"[^"]*")?\)')


def unlink(md):
    def one(m):
        if m[1]:
            return m[0]
        t = m[2].strip().strip("`")
        return "" if not t or not re.search("[A-Za-z0-9]", t) or t.lower() in text.GENERIC_LINKS else m[2]

    return LINK.sub(one, md)


def test_unlinked_matches_a_callback(spark):
    rnd = random.Random(1)
    bits = ["[", "]", "(", ")", "!", "a", "here", " ", "`", "¶", "[x](u)", "[Click here](u)", "![i](s)", '[t](u "q")', "[[source]](u)", "[¶](u)", "\n", "[``](u)", "[read more](v)"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(9))) for _ in range(800)]
    assert col(spark, texts, text.unlinked) == [unlink(t) for t in texts]


def test_chrome_lines(spark):
    assert col(spark, ["a\n Copied! \nb\n```py Skip to content\nedit this page now", None, ""], text.without_chrome_lines) == ["a\nb\nedit this page now", None, ""]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([3.0], [3.0])], "a array<float>, b array<float>")
    got = [(round(r[0], 6), r[1]) for r in df.select(vectors.cosine(F.col("a"), F.col("b")), vectors.l2(F.col("a"), F.col("b"))).collect()]
    assert got == [(0.8, 2.0), (0.0, 2.0), (1.0, 0.0)]


def test_parse_pairs(spark):
    ok = '[{"instruction": "q", "response": "a"}]'
    got = col(spark, [ok, f"```json\n{ok}\n```", f"Sure: {ok} bye", "[]", '{"instruction": 1}', "[1, {}]", '[{"instruction": "q"}]', '[{"instr', "", None], qajson.parse_pairs)
    assert [None if g is None else [tuple(p) for p in g] for g in got] == [[("q", "a")]] * 3 + [[], None, [], [], None, None, None]


def test_split_text():
    rnd = random.Random(2)
    for _ in range(200):
        t = "".join(rnd.choice("ab \n") + rnd.choice(["", "\n\n", " word"]) for _ in range(rnd.randrange(80)))
        for size, overlap in ((20, 0), (20, 5)):
            out = splitter.split_text(t, size, overlap)
            assert all(len(x) <= size and x == x.strip() and x for x in out)
            assert set("".join(out).replace(" ", "").replace("\n", "")) == set(t.replace(" ", "").replace("\n", ""))
    assert splitter.split_text(None) == splitter.split_text("") == splitter.split_text(" \n") == []
    assert splitter.split_text("one two three four", 9, 4) == ["one two", "three", "four"]
    with pytest.raises(ValueError):
        splitter.split_text("x", 5, 5)


def test_parent_child(spark):
    df = spark.createDataFrame([(1, "para one " * 60), (2, None), (3, "")], "id int, body string")
    got = splitter.parent_child(df, "body", (200, 20), (50, 10)).collect()
    assert {r["id"] for r in got} == {1} and all(r["chunk"] in r["parent_text"] for r in got)
    assert [r["child_no"] for r in got if r["parent_no"] == 0] == list(range(sum(r["parent_no"] == 0 for r in got)))


ROBOTS = "User-agent: a\nUser-agent: *\nDisallow: /\nAllow: /en/stable/ # ok\nCrawl-delay: 2\nSitemap: https://h/s.xml\n\nUser-agent: b\nDisallow:\nCrawl-delay: x"


def test_robots(spark):
    read = lambda text, agent="*": spark.createDataFrame([(text,)], "t string").select(robots.policy(F.col("t"), agent).alias("p")).first()["p"].asDict(recursive=True)
    p = read(ROBOTS)
    assert p["crawl_delay"] == 2.0 and p["sitemaps"] == ["https://h/s.xml"] and len(p["rules"]) == 2
    assert read(ROBOTS, "B") == {"rules": [], "crawl_delay": None, "sitemaps": ["https://h/s.xml"]}
    df = spark.createDataFrame([("https://h/en/stable/x", ROBOTS), ("https://h/", ROBOTS), ("https://h/en/latest/", ROBOTS), ("https://h/x", None), ("https://h/a.b?q=1", "User-agent: *\nDisallow: /*?q=1$\nAllow: /a.b"), ("https://h/aXb", "User-agent: *\nDisallow: /a.b")], "u string, t string")
    assert [r[0] for r in df.withColumn("p", robots.policy(F.col("t"))).select(robots.allowed(F.col("u"), F.col("p.rules"))).collect()] == [True, False, False, True, False, True]


def test_robots_groups(spark):
    text = "Disallow: /none\r\nUser-agent: A # first\nUSER-AGENT: b\nCrawl-delay: x\nCrawl-delay: 3\nunknown: 1\nDisallow: /p # end\nDisallow:\nAllow:\n\nUser-agent: *\nDisallow: /q\nSitemap:  https://h/a#b \nUser-agent: a\nAllow: /r\nno colon"
    rows = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    got = lambda agent: [(None if r["p"]["rules"] is None else [tuple(x) for x in r["p"]["rules"]], r["p"]["crawl_delay"], r["p"]["sitemaps"]) for r in rows.select(robots.policy(F.col("t"), agent).alias("p")).collect()]
    maps = ["https://h/a#b"]
    assert got("a") == [([("disallow", "/p"), ("allow", ""), ("allow", "/r")], 3.0, maps), ([], None, []), ([], None, [])]
    assert got("B")[0] == ([("disallow", "/p"), ("allow", "")], 3.0, maps)
    assert got("other")[0] == ([("disallow", "/q")], None, maps)


def test_pages(spark):
    page = "<html><nav><a href='/n'>x</a></nav><main><h1>Head</h1><p>One <a href='/b' title='t'>two</a><button>no</button><ul><li>a<li>b</ul><pre>c  d</pre><span aria-hidden=true>h</span><div style='display: none'>z</div></main><footer>f</footer>"
    got = col(spark, [page, None, "", "plain", "<p>un<b>closed"], html.page)
    assert got[0]["markdown"].replace("\n\n", "\n").split("\n")[:2] == ["# Head", "One two"]
    assert "* a" in got[0]["markdown"] and "c  d" in got[0]["markdown"] and not set("xfzh") & set(re.sub("[a-z]{2,}", "", got[0]["markdown"]))
    assert got[0]["hrefs"] == ["/n", "/b"] and got[1]["markdown"] is None and got[2]["markdown"] == "" and got[3]["markdown"] == "plain"


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from siltworks import checkpoints

    def session(master, named=None):
        kept = []
        unset = SimpleNamespace(isDefined=lambda: bool(kept), get=lambda: kept[-1])
        sc = SimpleNamespace(master=master, setCheckpointDir=kept.append, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: named))

    assert checkpoints.shared_dir(session("spark://h:7077", "hdfs://x")) == "hdfs://x"
    assert checkpoints.shared_dir(session("local[4]"))
    with pytest.raises(RuntimeError):
        checkpoints.shared_dir(session("spark://h:7077"))
