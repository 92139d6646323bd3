"""Oversized texts cut into overlapping pieces at natural boundaries.

Method: agglomerative merging. A text is broken into atomic segments (words,
with the white space after them; stretches without white space that exceed the
limit are cut by force). Each boundary between adjacent segments has a
strength: paragraph, line, sentence, word, forced. A heap holds the boundaries;
the weakest is merged first as long as the merged size plus the overlap stays
within the limit. The pieces that remain are separated by the strongest
boundaries that fit. Each piece then begins with the last ``overlap``
characters of the text before it.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORCED, WORD, SENTENCE, LINE, PARAGRAPH = range(5)
_ATOM = re.compile(r"\S+\s*|\s+")
_SENTENCE_END = re.compile(r"""[.!?。！？]["'”’)\]]*\s*$""")
_BLANK = re.compile(r"\n[^\S\n]*\n")
PIECES = "item_kind string, item_id long, piece_no int, start long, piece string, boundary string, cut string"
_NAMES = {FORCED: "forced", WORD: "word", SENTENCE: "sentence", LINE: "line", PARAGRAPH: "paragraph"}


def _strength(atom: str) -> int:
    """Of the boundary after a segment."""
    tail = atom[len(atom.rstrip()):]
    if not tail:
        return FORCED
    if _BLANK.search(tail):
        return PARAGRAPH
    if "\n" in tail or "\r" in tail:
        return LINE
    return SENTENCE if _SENTENCE_END.search(atom) else WORD


def cut_text(text: str, limit: int, overlap: int) -> tuple[list[tuple[int, int, int]], bool]:
    """Pieces as (start, end, strength of the boundary before), and whether a stretch had to be cut by force.

    Starts include the overlap; every piece has at most ``limit`` characters.
    Equal boundaries are merged from the left. A text within the limit is one
    piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be in [0, limit)")
    if len(text) <= limit:
        return ([(0, len(text), PARAGRAPH)] if text else []), False
    room = limit - overlap
    starts, strengths, forced = [], [], False
    for m in _ATOM.finditer(text):
        a, b = m.span()
        solid = len(m.group().rstrip())
        forced |= solid > limit
        while b - a > room:
            starts.append(a)
            strengths.append(FORCED if a + room < m.start() + solid else WORD)
            a += room
        starts.append(a)
        strengths.append(_strength(text[a:b]))
    n = len(starts)
    size = [b - a for a, b in zip(starts, starts[1:] + [len(text)])]
    # neighbours as a linked list; a boundary is named by its left segment's last atom
    right, left, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    end = strengths[:]
    stamp = [0] * n
    heap = [(strengths[i], i, 0, 0) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, i, ti, tj = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if not alive[i] or j >= n or stamp[i] != ti or stamp[j] != tj or size[i] + size[j] > room:
            continue
        size[i] += size[j]
        end[i] = end[j]
        alive[j] = False
        right[i] = right[j]
        stamp[i] += 1
        if right[i] < n:
            left[right[i]] = i
            heapq.heappush(heap, (end[i], i, stamp[i], stamp[right[i]]))
        if left[i] >= 0:
            heapq.heappush(heap, (end[left[i]], left[i], stamp[left[i]], stamp[i]))
    pieces, before = [], PARAGRAPH
    i = 0
    while i < n:
        a = starts[i]
        pieces.append((max(0, a - overlap) if pieces else a, a + size[i], before))
        before = end[i]
        i = right[i]
    return pieces, forced


def split_oversized(df: DataFrame, kind: str, item_id: str, text: str | Column, limit: int = 2000, overlap: int = 200) -> DataFrame:
    """Pieces of every text over ``limit`` characters: item_kind, item_id, piece_no, start, piece, boundary, cut.

    Pieces are consecutive, at most ``limit`` Unicode characters long and, after
    the first, begin with the ``overlap`` characters before them. ``boundary``
    names the boundary before a piece's own text, ``cut`` is ``forced`` if the
    item holds a stretch of more than ``limit`` characters without white space.
    Null, empty and short texts give no rows. Repeated rows of one item_id give
    its pieces once (the smallest text if they differ). Only oversized texts
    leave the JVM.
    """
    c = F.col(text) if isinstance(text, str) else text
    big = df.select(F.col(item_id).cast("long").alias("item_id"), c.alias("text")).where(F.length("text") > limit)

    def run(batches):
        for pdf in batches:
            out = []
            for key, t in zip(pdf["item_id"], pdf["text"]):
                pieces, forced = cut_text(t, limit, overlap)
                out += [(kind, key, k, a, t[a:b], _NAMES[s] if k else "start", "forced" if forced else "natural") for k, (a, b, s) in enumerate(pieces)]
            yield pd.DataFrame(out, columns=["item_kind", "item_id", "piece_no", "start", "piece", "boundary", "cut"])

    once = big.groupBy("item_id").agg(F.min("text").alias("text"))
    return once.mapInPandas(run, PIECES)
