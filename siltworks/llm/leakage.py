"""Evaluation texts leaking into training text.

Method: the n-grams of the normalised evaluation items form a hash set that is
broadcast behind a check of its size; training documents are scanned window by
window; hits are verified word by word. A document can be reported with the
items it holds, or dropped; no spans are removed from texts.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("аеорсхуіјѕһԁԛԝвкмнтгαοερτυινκβμηχγѵɡ", "aeopcxyijshdqwbkmhtraoeptuivkbmnxyvg"))
_MAP = {ord(k): v for k, v in LOOKALIKES.items()} | {c: None for c in [*range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF, 0xAD, 0x180E, 0x34F]}
_MAP |= {ord(c): None for c in "'’‘ʼ`´"} | {c: None for c in range(0x300, 0x370)} | {ord("ß"): "ss", ord("ø"): "o", ord("ł"): "l", ord("đ"): "d", ord("ı"): "i"}
_TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>", re.S)
_LINK = re.compile(r"\[([^\]\[]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)")
_WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    """Lower case without markup, accents, invisible marks, apostrophes; look-alike letters as Latin ones."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if "&" in text:
        text = html.unescape(text)
    text = text.lower()
    if text.isascii():
        return text.replace("'", "").replace("`", "")
    return unicodedata.normalize("NFKD", text).casefold().translate(_MAP)


def folded_words(text: str | None) -> list[str]:
    return _WORD.findall(folded(text)) if text else []


def item_windows(items: DataFrame, item_id: str, text: str, n: int, max_windows: int) -> dict[tuple[str, ...], list[int]]:
    """Windows of ``n`` words to the items that hold them; refuses more than ``max_windows``."""
    out: dict[tuple[str, ...], list[int]] = {}
    for r in items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null and i is not null").toLocalIterator():
        ws = folded_words(r["t"])
        for k in range(len(ws) - n + 1):
            out.setdefault(tuple(ws[k : k + n]), [])
            if r["i"] not in out[tuple(ws[k : k + n])]:
                out[tuple(ws[k : k + n])].append(r["i"])
        if len(out) > max_windows:
            raise ValueError(f"evaluation items hold more than {max_windows} windows: too many to broadcast")
    return out


def scan(ws: list[str], windows: dict, known: set, n: int) -> list[tuple[int, list[int]]]:
    """(position, items) of each window that is held by an item.

    Every window of n words covers one position of n-1, 2n-1, ...: only where
    the word there is in the items are its neighbours looked at.
    """
    found, done = [], -1
    for at in range(n - 1, len(ws), n):
        if ws[at] not in known:
            continue
        a = at
        low = max(done + 1, at - n + 1)
        while a > low and ws[a - 1] in known:
            a -= 1
        b = at + 1
        high = min(len(ws), at + n)
        while b < high and ws[b] in known:
            b += 1
        for k in range(a, b - n + 1):
            hit = windows.get(tuple(ws[k : k + n]))
            if hit:
                found.append((k, hit))
            done = k
    return found


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 12, max_windows: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id, windows, first_word): documents that hold ``n`` consecutive words of an item.

    Words are compared apart from case, punctuation, markup, spacing and
    character variants. Items of fewer than ``n`` words have no windows. Null
    and empty texts match nothing; a document delivered twice under one id
    counts once. The windows are broadcast; more than ``max_windows`` of them
    raise ValueError, since evaluation sets are small and fixed.
    """
    if n < 1:
        raise ValueError("n must be positive")
    windows = item_windows(items, item_id, item_text, n, max_windows)
    shared = docs.sparkSession.sparkContext.broadcast((windows, {w for k in windows for w in k}))

    def run(batches):
        wins, known = shared.value
        for b in batches:
            out = []
            for i, t in zip(b["i"], b["t"]):
                hits: dict[int, list[int]] = {}
                for k, held in scan(folded_words(t), wins, known, n):
                    for x in held:
                        hits.setdefault(x, []).append(k)
                out += [(i, x, len(ks), ks[0]) for x, ks in hits.items()]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "windows", "first_word"])

    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null and i is not null")
    return rows.mapInPandas(run, "doc_id long, item_id long, windows long, first_word long").groupBy("doc_id", "item_id").agg(F.max("windows").alias("windows"), F.min("first_word").alias("first_word"))


def without_leaks(docs: DataFrame, leaks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents that hold no item, unchanged."""
    bad = leaks.select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(bad, doc_id, "left_anti")
