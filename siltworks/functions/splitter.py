"""Recursive character splitting into overlapping chunks, and parent-child chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = ("\n\n", "\n", " ", "")


def _merge(parts: list[str], sep: str, size: int, overlap: int) -> list[str]:
    """Neighbouring parts joined up to ``size``; each chunk starts with parts of the last one worth at most ``overlap``."""
    out: list[str] = []
    held: list[str] = []
    total = 0
    for p in parts:
        joint = len(sep) if held else 0
        if held and total + len(p) + joint > size:
            text = sep.join(held).strip()
            if text:
                out.append(text)
            while held and (total > overlap or total + len(p) + (len(sep) if held else 0) > size):
                total -= len(held[0]) + (len(sep) if len(held) > 1 else 0)
                held.pop(0)
        total += len(p) + (len(sep) if held else 0)
        held.append(p)
    text = sep.join(held).strip()
    if text:
        out.append(text)
    return out


def split_text(text: str | None, size: int = 2000, overlap: int = 0, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` characters where separators allow, cut at the first separator that the text holds.

    Pieces still too long are cut by the next separators; the separator leads the
    piece that follows it. Null, empty and blank texts give none.
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("size must be positive and overlap in [0, size)")
    if not text:
        return []
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    sep, rest = separators[at], separators[at + 1 :]
    if sep:
        cut = text.split(sep)
        parts = [cut[0], *(sep + x for x in cut[1:])]
        parts = [p for p in parts if p]
    else:
        parts = list(text)
    out: list[str] = []
    small: list[str] = []
    for p in parts:
        if len(p) < size:
            small.append(p)
            continue
        if small:
            out += _merge(small, "", size, overlap)
            small = []
        out += split_text(p, size, overlap, rest) if rest else [p]
    return out + _merge(small, "", size, overlap) if small else out


def chunks(c: Column, size: int = 2000, overlap: int = 0) -> Column:
    """Array of chunks of a text column."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: split_text(t, size, overlap))

    return cut(c)


def parent_child(df: DataFrame, text: str, parent: tuple[int, int] = (2000, 200), child: tuple[int, int] = (400, 200)) -> DataFrame:
    """One row per child chunk: all columns of df, parent_no, child_no, parent_text, text of the child as ``chunk``."""
    kind = T.ArrayType(T.StructType([T.StructField("parent_text", T.StringType()), T.StructField("children", T.ArrayType(T.StringType()))]))

    @F.pandas_udf(kind)
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"parent_text": p, "children": split_text(p, *child)} for p in split_text(t, *parent)])

    out = df.select("*", F.posexplode(cut(F.col(text))).alias("parent_no", "_p"))
    out = out.select("*", F.posexplode("_p.children").alias("child_no", "chunk"))
    return out.withColumn("parent_text", F.col("_p.parent_text")).drop("_p")
