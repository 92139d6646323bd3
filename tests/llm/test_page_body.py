from pyspark.sql import functions as F

from siltworks.llm.page_body import furniture_lines, main_body, page_furniture, render, repeats, tree

PAGE = """Skip to content
* [Home](/home)
* [Docs](/docs)
You are here: A » B » C
We use cookies to measure visits. Accept all | Reject | Manage
# Title of the page

A sentence with `a_setting` in it.

These are covered:
* [a thing](/x)
* plain thing

On this page
Title of the page
Another label

| a | b |
|---|---|
| 1 | 2 |

```
menu | home | about
```

> Note: kept.

Tags: one, two
← Previous: Some page   Next: Other page →
Terms | Privacy | Legal
© 2022 Some authors"""


def test_lines():
    bad = {PAGE.split("\n")[n - 1] for n in furniture_lines(PAGE)}
    assert bad == {
        "Skip to content", "* [Home](/home)", "* [Docs](/docs)", "You are here: A » B » C", "We use cookies to measure visits. Accept all | Reject | Manage",
        "On this page", "Title of the page", "Another label", "Tags: one, two", "← Previous: Some page   Next: Other page →", "Terms | Privacy | Legal", "© 2022 Some authors",
    }


def test_odd_texts():
    for t in ("", "\n\n", " ", "```\nopen fence", "x" * 100_000, "|" * 500, "[" * 300):
        furniture_lines(t)


def test_rendering():
    html = "<html><head><title>x</title><style>p{}</style></head><body><nav>menu</nav><h2>Head</h2><p>One<p>Two <b>bold</b><ul><li>a<li>b</ul><table><tr><th>k<th>value<tr><td>longer<td>1</table><div style='display: none'>no</div><div hidden>no</div><pre>  code\n    x</pre><footer>f</footer>"
    text = render(tree(html), main_only=False)
    assert text == "menu\n\n## Head\n\nOne\n\nTwo bold\n\n- a\n- b\n\nk      | value\nlonger | 1\n\n  code\n    x\n\nf"
    assert render(tree(html)).startswith("## Head") and not render(tree(html)).endswith("f")


def test_operator(spark):
    rows = [(1, PAGE), (1, PAGE), (2, None), (3, ""), (4, "Only text here.")]
    df = spark.createDataFrame(rows, "record_id long, source_chunk string").withColumn("line_no", F.lit(9))
    got = page_furniture(df).collect()
    assert {r["record_id"] for r in got} == {1} and len(got) == len(furniture_lines(PAGE))
    body = {r["record_id"]: r["body"] for r in main_body(df).collect()}
    assert body[2] is None and body[3] == "" and body[4] == "Only text here." and body[1].startswith("# Title")
    assert page_furniture(df.limit(0)).count() == 0


def test_html_lines_by_their_elements():
    html = """<!doctype html>
<body>
<nav class="top">
<a href="/a">First words of some kind.</a>

A sentence in Markdown inside the menu.
</nav>
<!-- a note
of the authors -->
<article>
<h1>Title of the page</h1>
The `<nav>` element holds menus.
<p>A sentence with <b>bold</b> words.
<ul>
<li><a href="/x">Some link</a>
<li>An item of the article.
</ul>
<p style="display: none">Not shown at all.</p>
<div role="search">
Anything here.
</div>
<pre>
menu | home | about
</pre>
</article>
<script>
if (a < b) { go(); }
</script>
<footer>The end of it all.</footer>
</body>

The `<nav>` element holds menus, and <aside> others.
```html
<nav>
```
A last sentence."""
    bad = [html.split("\n")[n - 1] for n in furniture_lines(html)]
    assert bad == [
        '<nav class="top">', '<a href="/a">First words of some kind.</a>', "A sentence in Markdown inside the menu.", "</nav>", "<!-- a note", "of the authors -->",
        '<li><a href="/x">Some link</a>', '<p style="display: none">Not shown at all.</p>', '<div role="search">', "Anything here.", "</div>",
        "<script>", "if (a < b) { go(); }", "</script>", "<footer>The end of it all.</footer>",
    ]


def test_elements_nested_deeply_keep_their_sight():
    deep = "<div>" * 600 + "<nav>menu</nav><p hidden>no</p><section><p>yes</p></section>" + "</div>" * 600 + "<p>after</p>"
    assert render(tree(deep)) == "yes\n\nafter"
    assert render(tree(deep), main_only=False) == "menu\n\nyes\n\nafter"


def test_repeated_lines_apart_from_prose_are_furniture(spark):
    def page(k):
        return f"""Brezel {"Haus Tor Rad".split()[k % 3]} zum Mitnehmen
Topf

# Page {k}
A sentence about the matter number{k} that has ten words or more in it.
A line that stands below the prose of all pages here.

Some paragraph of page{k} with its own words, which is long enough to be prose.
```
Topf
```
{"word " * 90}{k} and a long notice in one line of more than 260 characters"""

    df = spark.createDataFrame([(k, page(k)) for k in range(12)] + [(0, page(0)), (99, None), (98, "")], "record_id long, source_chunk string")
    assert furniture_lines(page(3)) == []
    got = {(r["record_id"], r["line_no"]) for r in page_furniture(df).collect()}
    # the long line differs in its number alone, which is none of its words
    assert got == {(k, n) for k in range(12) for n in (1, 2, 12)}
    body = {r["record_id"]: r["body"] for r in main_body(df).collect()}
    assert body[4].startswith("# Page 4\nA sentence") and body[4].endswith("```\nTopf\n```") and body[99] is None and body[98] == ""
    assert repeats(df.limit(0)).pages.sum() == 0


def test_bodies_are_rendered():
    from siltworks.llm.page_body import page_tree, render_page

    t = "One\n\n\n\n| a | bcd |\n|---|---|\n| long | 1 |\n\n```\n  x\n\n  y\n```\n* i\n  * j"
    assert render_page(page_tree(t), {1}) == "| a    | bcd |\n| ---- | --- |\n| long | 1   |\n\n```\n  x\n\n  y\n```\n\n* i\n  * j"
