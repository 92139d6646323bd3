"""HTML pages: main text as Markdown, links, with page chrome left out."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import unlinked, without_chrome_lines

# Elements and roles that are page chrome by default.
EXCLUDED_TAGS = ("nav", "header", "footer", "aside", "button", "script", "style", "noscript")
EXCLUDED_ROLES = ("navigation", "banner", "contentinfo", "complementary", "button")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("address article blockquote dd div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 hr li main ol p pre section table tr ul".split())
# A block ends an open paragraph, as far as no container lies between.
_SCOPES = frozenset("article aside blockquote body button div footer header main nav section td th".split())
_CLOSES = {t: ("p",) for t in _BLOCK | {"aside", "footer", "header", "nav"}} | {"li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class _Markdown(HTMLParser):
    """Markdown of the elements that are not excluded, and all links."""

    def __init__(self, tags: tuple[str, ...], roles: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.tags, self.roles = set(tags), set(roles)
        self.stack: list[tuple[str, bool]] = []
        self.hidden = 0
        self.out: list[str] = []
        self.hrefs: list[str] = []
        self.lists: list[list] = []
        self.link: tuple[str, int] | None = None
        self.pre = 0

    def _dropped(self, tag: str, a: dict) -> bool:
        style = re.sub(r"\s", "", a.get("style") or "").lower()
        return tag in self.tags or a.get("role") in self.roles or a.get("aria-hidden") == "true" or "hidden" in a or "display:none" in style

    def _close(self, k: int) -> None:
        while len(self.stack) > k:
            tag, dropped = self.stack.pop()
            if dropped:
                self.hidden -= 1
            elif not self.hidden:
                self._end(tag)

    def _end(self, tag: str) -> None:
        if tag == "a" and self.link:
            href, at = self.link
            text = "".join(self.out[at:])
            self.out[at:] = [f"[{text.strip()}]({href})"] if href and not re.search(r"\s", href) else [text]
            self.link = None
        elif tag == "pre":
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.out.append("\n\n")
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag in _BLOCK:
            self.out.append("\n" if tag in ("li", "tr") else "\n\n")

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "a" and a.get("href", "").strip():
            self.hrefs.append(a["href"].strip())
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in _CLOSES.get(tag, ()):
                self._close(k)
                break
            if self.stack[k][0] in ("ul", "ol", "table", "dl") or (tag not in ("li", "dt", "dd", "tr") and self.stack[k][0] in _SCOPES):
                break
        dropped = self._dropped(tag, a)
        if tag in _VOID:
            if not self.hidden and not dropped:
                self.out.append({"br": "\n", "hr": "\n\n---\n\n", "img": f"![{a.get('alt', '')}]({a.get('src', '')})"}.get(tag, ""))
            return
        self.stack.append((tag, dropped))
        self.hidden += dropped
        if self.hidden:
            return
        if re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "a":
            self.link = (a.get("href", "").strip(), len(self.out))
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n```\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n")
        elif tag == "li":
            mark = "* "
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                mark = f"{self.lists[-1][1]}. "
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + mark)
        elif tag in _BLOCK:
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self._close(k)
                return

    def handle_data(self, data):
        if self.hidden:
            return
        if not self.pre:
            data = re.sub(r"\s+", " ", data)
            # a block begins without blanks
            if data.startswith(" ") and (not self.out or self.out[-1].endswith(("\n", " "))):
                data = data[1:]
        if data:
            self.out.append(data)


def read_page(html: str | None, tags: tuple[str, ...] = EXCLUDED_TAGS, roles: tuple[str, ...] = EXCLUDED_ROLES) -> dict:
    """Markdown without page chrome, and all links of a page; both null for null."""
    if html is None:
        return {"markdown": None, "hrefs": None}
    p = _Markdown(tags, roles)
    p.feed(html)
    p.close()
    p._close(0)
    lines = [x.rstrip() for x in "".join(p.out).split("\n")]
    return {"markdown": re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n"), "hrefs": p.hrefs}


PAGE = T.StructType([T.StructField("markdown", T.StringType()), T.StructField("hrefs", T.ArrayType(T.StringType()))])


def page(html: Column, tags: tuple[str, ...] = EXCLUDED_TAGS, roles: tuple[str, ...] = EXCLUDED_ROLES) -> Column:
    """Struct of markdown and hrefs of an HTML column. The tree is read in Python; links and lines are cleaned in the JVM."""

    @F.pandas_udf(PAGE)
    def read(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(h if isinstance(h, str) else None, tags, roles) for h in s], columns=["markdown", "hrefs"])

    raw = read(html)
    return F.struct(without_chrome_lines(unlinked(raw["markdown"])).alias("markdown"), raw["hrefs"].alias("hrefs"))
