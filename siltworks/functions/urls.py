"""Url columns: normal form, host, path, section."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARTS = r"(?is)^(https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
#: White space as Unicode has it.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Both ends without any Unicode white space (``trim`` alone drops spaces only)."""
    return F.btrim(c, F.lit(BLANKS))


def normal_url(c: Column) -> Column:
    """The normal form of an absolute http(s) url, as JVM expressions only.

    Surrounding blanks and the fragment are dropped, scheme and host go to
    lower case, trailing slashes leave the path (a bare root stays ``/``), query
    parameters are sorted, blank ones kept. Null, blank and anything that is
    no absolute http(s) url give null. Percent escapes stay as written; see
    :func:`resolve_url` for the form that re-encodes them.
    """

    def build(p: Column) -> Column:
        params = F.array_sort(F.filter(F.split(p[3], "&"), lambda x: x != ""))
        path = F.rtrim(p[2], F.lit("/"))
        query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit(""))
        whole = F.concat(F.lower(p[0]), F.lit("://"), F.lower(p[1]), F.when(path == "", F.lit("/")).otherwise(path), query)
        return F.when((F.size(p) == 4) & (p[1] != ""), whole)

    # one match gives all parts; the array is there so that it is made once
    parts = F.split(F.regexp_replace(strip(c), _PARTS, "$1\u0001$2\u0001$3\u0001$4"), "\u0001", -1)
    return F.get(F.transform(F.array(parts), build), F.lit(0))


@F.pandas_udf(T.StringType())
def resolve_url(href: pd.Series, base: pd.Series) -> pd.Series:
    """Links resolved against their page and brought to the normal form.

    Null for blank links, for schemes other than http(s), and for links that
    cannot be parsed. Query pairs are decoded, sorted and encoded again.
    """
    from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit

    def one(h, b):
        if not isinstance(h, str) or not h.strip():
            return None
        try:
            p = urlsplit(urljoin(b if isinstance(b, str) else "", h.strip()))
            netloc = p.netloc
        except ValueError:
            return None
        if p.scheme.lower() not in ("http", "https") or not netloc:
            return None
        pairs = sorted(parse_qsl(p.query, keep_blank_values=True))
        return f"{p.scheme.lower()}://{netloc.lower()}{p.path.rstrip('/') or '/'}" + ("?" + urlencode(pairs) if pairs else "")

    return pd.Series([one(h, b) for h, b in zip(href, base)], index=href.index, dtype=object)


def host(c: Column) -> Column:
    """Host and port of a url in normal form; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(c, r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def path(c: Column) -> Column:
    """Path of a url, ``/`` if it has none; null for null."""
    p = F.regexp_extract(c, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(c.isNotNull(), F.when(p == "", F.lit("/")).otherwise(p))


def path_segments(c: Column) -> Column:
    return F.filter(F.split(path(c), "/"), lambda x: x != "")


def section(c: Column, depth: int = 2) -> Column:
    """The first ``depth`` path segments; ``root`` for a url without path."""
    if depth < 1:
        raise ValueError("depth must be positive")
    s = F.array_join(F.slice(path_segments(c), 1, depth), "/")
    return F.when(s == "", F.lit("root")).otherwise(s)


def branch(c: Column, home: str) -> Column:
    """Category of a link for discovery: another host, the site's root level, or the first path segment."""
    segs = path_segments(c)
    return (
        F.when(host(c) != F.lit(home.lower()), F.concat(F.lit("External: "), host(c)))
        .when(F.size(segs) == 0, F.lit("Root Level"))
        .otherwise(F.concat(F.lit("Path: /"), F.element_at(segs, 1), F.lit("/*")))
    )


def named_section(c: Column) -> Column:
    """A section label in lower case without surrounding blanks and slashes; null if it names none."""
    s = F.regexp_replace(F.lower(c), r"^[\s/\x{A0}]+|[\s/\x{A0}]+$", "")
    return F.when(~s.isin("", "unknown", "root"), s)
