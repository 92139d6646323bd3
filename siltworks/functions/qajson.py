"""Question-answer pairs out of a language model's response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = "array<struct<instruction:string,response:string>>"
_LOOSE = "array<map<string,string>>"


def _as_list(text: Column) -> Column:
    """The text as a JSON list, null if it is none."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), v)


def parse_pairs(response: Column) -> Column:
    """Array of (instruction, response) of a response; null if it holds no JSON list.

    Three readings are tried: the text itself, the text without a code fence, and
    from the first ``[`` to the last ``]``; the first that is a list counts. Elements
    that are no objects or lack a key are left out, so ``[]`` means no pairs while
    null means malformed. Values that are no strings are given as JSON text.
    """
    text = F.btrim(response, F.lit(" \t\r\n"))
    unfenced = F.btrim(F.regexp_replace(text, r"(?m)^```(?:json)?\s*|\s*```$", ""), F.lit(" \t\r\n"))
    inner = F.nullif(F.regexp_extract(text, r"(?s)(\[.*\])", 1), F.lit(""))
    found = F.coalesce(_as_list(text), _as_list(unfenced), _as_list(inner))
    items = F.try_variant_get(found, "$", "array<variant>")
    is_pair = lambda v: F.schema_of_variant(v).startswith("OBJECT") & F.try_variant_get(v, "$.instruction", "variant").isNotNull() & F.try_variant_get(v, "$.response", "variant").isNotNull()
    pair = lambda v: F.struct(F.try_variant_get(v, "$.instruction", "string").alias("instruction"), F.try_variant_get(v, "$.response", "string").alias("response"))
    return F.when(found.isNotNull(), F.transform(F.filter(items, is_pair), pair))
