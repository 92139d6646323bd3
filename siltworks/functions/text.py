"""Text columns: chunk identity, slugs, titles, licence signals, links, page chrome lines. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lines that are page chrome, link texts that name nothing, and
# file names that one platform reserves.
CHROME_LINES = (
    "copy to clipboard", "copied to clipboard", "copied!", "make interactive", "skip to content", "skip to main content", "skip navigation",
    "back to top", "scroll to top", "view this page", "edit this page", "toggle navigation", "toggle table of contents", "toggle theme",
)
GENERIC_LINKS = (
    "here", "this", "link", "click here", "this page", "this link", "read more", "more", "learn more", "source", "top", "¶", "skip to content",
    "skip to main content", "skip navigation", "back to top", "scroll to top", "view this page", "edit this page",
)
RESERVED_NAMES = ("CON", "PRN", "AUX", "NUL", *(f"COM{i}" for i in range(1, 10)), *(f"LPT{i}" for i in range(1, 10)))
# Licence phrases, the first pattern that matches anywhere wins.
LICENCE_PATTERNS = (
    r"(?i)creative commons(?:\s+attribution)?(?:[\s-]+\S+){0,4}",
    r"(?i)CC[\s-]BY(?:-[A-Z]+)*(?:\s+\d(?:\.\d)?)?",
    r"(?i)MIT license",
    r"(?i)apache license(?:,?\s+version\s+[\d.]+)?",
    r"(?i)all rights reserved",
    r"©\s*\d{4}[^\n]{0,80}",
)

_SPACE = r"[\s\x{85}\x{A0}\x{1C}-\x{1F}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def collapsed(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def chunk_key(c: Column) -> Column:
    """The form in which chunk texts and questions are compared: collapsed, lower case, no closing ``.,;:!?``."""
    return F.rtrim(F.lower(collapsed(c)), F.lit(".,;:!?"))


def chunk_id(c: Column) -> Column:
    """Content-addressed id of a chunk: sha-256 of its key, in hex; null for null."""
    return F.sha2(chunk_key(c), 256)


def near_key(c: Column) -> Column:
    """The form in which near duplicates are compared: lower case, only ``a-z``, ``0-9`` and spaces; empty for null."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", "")


def slug(c: Column, longest: int = 60) -> Column:
    """File-name slug of a label: capped with a digest, reserved names avoided, ``root`` if nothing is left."""
    raw = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    base = F.when(raw == "", F.lit("root")).otherwise(raw)
    capped = F.when(F.length(base) > longest, F.concat(F.substring(base, 1, longest - 9), F.lit("-"), F.substring(F.sha2(base, 256), 1, 8))).otherwise(base)
    return F.when(F.upper(capped).isin(*RESERVED_NAMES), F.concat(capped, F.lit("-section"))).otherwise(capped)


def slugs(labels: DataFrame, label: str = "section") -> DataFrame:
    """(label, slug) of distinct labels, one slug each.

    Labels whose slugs collide are numbered in label order, from the second on;
    a number never meets another label's own slug, since those come first and a
    numbered slug that is taken is given a digest as well.
    """
    base = labels.select(F.col(label).alias("label")).where("label is not null").distinct().withColumn("base", slug(F.col("label")))
    n = base.withColumn("n", F.row_number().over(Window.partitionBy("base").orderBy("label")) - 1)
    own = n.where("n = 0").select(F.col("base").alias("cand"), F.lit(True).alias("taken"))
    cand = n.withColumn("cand", F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("n").cast("string"))))
    joined = cand.join(own, "cand", "left")
    clash = (F.col("n") > 0) & F.col("taken")
    return joined.select(F.col("label").alias(label), F.when(clash, F.concat_ws("-", "cand", F.substring(F.sha2("label", 256), 1, 8))).otherwise(F.col("cand")).alias("slug"))


def page_title(md: Column) -> Column:
    """Text of the first level-one heading without links; null if there is none or it is blank."""
    head = F.regexp_extract(md, r"(?m)^#\s+(.+)$", 1)
    return F.nullif(F.btrim(F.regexp_replace(head, r"\[.*?\]\(.*?\)", ""), F.lit(" \t\n\r\x0b\x0c")), F.lit(""))


def licence_signal(md: Column) -> Column:
    """The first licence phrase, by the order of the patterns; null if there is none."""
    return F.coalesce(*[F.nullif(F.btrim(F.regexp_extract(md, p, 0), F.lit(" \t\n\r")), F.lit("")) for p in LICENCE_PATTERNS])


def headings(md: Column) -> Column:
    """Lines that start with ``#``, trimmed, joined by line breaks; empty if there are none."""
    return F.array_join(F.filter(F.transform(F.split(md, "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x.startswith("#")), "\n")


def _quoted(words) -> str:
    return "|".join("".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in w) for w in words)


def unlinked(md: Column, generic: tuple[str, ...] = GENERIC_LINKS) -> Column:
    """Links as their visible text; links that name nothing disappear, images stay.

    One alternation decides per link: an image is kept whole, a link whose text is
    generic or holds no letter or digit of ASCII is dropped, any other gives its text.
    """
    target = r"\]\([^)\s]+(?:\s+\"[^\"]*\")?\)"
    text = r"(?:[^\[\]]|\[[^\[\]]*\])*"
    image = rf"(!\[{text}{target})"
    empty = rf"\[(?:(?:(?![A-Za-z0-9])[^\[\]]|\[(?:(?![A-Za-z0-9])[^\[\]])*\])*|[\s`]*(?i:{_quoted(generic)})[\s`]*){target}"
    return F.regexp_replace(md, rf"{image}|{empty}|\[({text}){target}", "$1$2")


def without_chrome_lines(md: Column, patterns: tuple[str, ...] = CHROME_LINES) -> Column:
    """Text without the lines that are nothing but a chrome phrase, a code fence before it allowed."""
    listed = F.array(*[F.lit(p.lower()) for p in patterns])
    bare = lambda x: F.btrim(F.regexp_replace(F.lower(F.btrim(x, F.lit(" \t\r"))), r"^```\w*\s*", ""), F.lit(" \t\r"))
    return F.array_join(F.filter(F.split(md, "\n"), lambda x: ~F.array_contains(listed, bare(x))), "\n")


def prefix_chars(c: Column, n: int) -> Column:
    """The first ``n`` code points."""
    return F.substring(c, 1, n)


def fixed(c: Column, digits: int = 4) -> Column:
    """A number with a fixed count of digits after the point, without group marks."""
    return F.format_string(f"%.{digits}f", c.cast("double"))
