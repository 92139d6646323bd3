"""Words and settings of questions and answers, as JVM expressions and in Python."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

SETTING = r"[a-z0-9]+(?:_[a-z0-9]+)+"
_TAG = r"</?[A-Za-z][^<>]*>"
_ENTITY = r"&(?:[a-zA-Z]{2,8}|#[0-9]{1,7});"
_LINK = r"!?\[([^\]\[]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)"

_tag, _entity, _link = (re.compile(x) for x in (_TAG, _ENTITY, _LINK))
_word = re.compile(r"[^\W_]+")


def plain(c: Column) -> Column:
    """Text without tags, character references and link targets."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, _LINK, "$1"), _TAG, " "), _ENTITY, " ")


def word_array(c: Column) -> Column:
    """Runs of letters or digits in lower case, without markup; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(plain(c)), F.lit(r"([\p{L}\p{N}\p{M}]+)"), F.lit(1)), F.array().cast("array<string>"))


def setting(c: Column) -> Column:
    """The first identifier of several parts joined by ``_``, in lower case; null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(c), SETTING, 0), F.lit(""))


def words(text: str | None) -> list[str]:
    """The Python form of :func:`word_array`."""
    if not text:
        return []
    return _word.findall(_entity.sub(" ", _tag.sub(" ", _link.sub(r"\1", text))).lower())


def in_order(a: list[str], b: list[str]) -> int:
    """Words matched in order (longest common subsequence), by bit rows."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & at.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def near(a: str, b: str) -> bool:
    """Whether two words are the same but for at most two edits of letters (a swap is one)."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 4:
        return False
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return max(len(a), len(b)) <= 2


def two_edits(a: bytes, b: bytes, most: int = 2) -> bool:
    """Whether ``most`` (2 at most) insertions, deletions, changes or swaps of neighbours make ``a`` into ``b``.

    As in the unrestricted Damerau-Levenshtein distance, a byte may stand between two that are swapped, for one more.
    """
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    if not a or not b or not most:
        return len(a) + len(b) <= most
    if abs(len(a) - len(b)) > most:
        return False
    if two_edits(a[1:], b[1:], most - 1) or two_edits(a[1:], b, most - 1) or two_edits(a, b[1:], most - 1):
        return True
    if a[:1] == b[1:2] and b[:1] == a[1:2] and two_edits(a[2:], b[2:], most - 1):
        return True
    return most == 2 and (a[:1] == b[2:3] and b[:1] == a[1:2] and a[2:] == b[3:] or b[:1] == a[2:3] and a[:1] == b[1:2] and b[2:] == a[3:])


def spelt_alike(a: str, b: str) -> bool:
    """Whether two words are equal or, with more than three letters, at most two edits apart, counted in bytes as SQL does."""
    return a == b or (min(len(a), len(b)) > 3 and abs(len(a) - len(b)) < 3 and two_edits(a.encode(), b.encode()))


def name_array(question: Column) -> Column:
    """Capitalised words inside a question of mixed case, in lower case: its proper names."""
    found = F.regexp_extract_all(F.regexp_replace(question, r"[^\t\n\f\r ]*_[^\t\n\f\r ]*", " "), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))
    first = lambda x: F.substring(x, 1, 1)
    named = F.filter(F.slice(found, 2, F.greatest(F.lit(1), F.size(found))), lambda x: (F.length(x) > 3) & (first(x) != F.lower(first(x))) & (x != F.upper(x)))
    return F.when(F.exists(found, lambda x: x == F.lower(x)), F.transform(named, lambda x: F.lower(x))).otherwise(F.array().cast("array<string>"))


def names(question: str) -> set[str]:
    """Capitalised words inside a question of mixed case, in lower case: its proper names."""
    text = re.sub(r"[^\s]*_[^\s]*", " ", question)
    found = re.findall(r"[^\W\d_]+", text)
    if not any(w.islower() for w in found):
        return set()
    return {w.lower() for w in found[1:] if w[0].isupper() and not w.isupper() and len(w) > 3}


def agree(na: Collection[str], wa: Collection[str], nb: Collection[str], wb: Collection[str]) -> bool:
    """Whether no question names something that the other lacks while the other does so too; from both names and words."""
    lost_a = any(n not in wb and not any(spelt_alike(n, w) for w in wb) for n in na)
    lost_b = any(n not in wa and not any(spelt_alike(n, w) for w in wa) for n in nb)
    if lost_a and lost_b:
        return False
    # if the other is all in one case, a name stands there as an ordinary word
    return not ((lost_a and not nb) or (lost_b and not na))


def same_names(qa: str, qb: str) -> bool:
    """:func:`agree` of two questions' texts."""
    return agree(names(qa), set(words(qa)), names(qb), set(words(qb)))
