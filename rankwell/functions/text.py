"""Text functions on wikitext and rendered pages, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: attributes that make a rendered page heavy.
HEAVY = ("src", "srcset", "style", "decoding", "loading", "width", "height")

def strip_comments(text: Column) -> Column:
    """Without HTML comments; one that is never closed runs to the end."""
    closed = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    return F.regexp_replace(closed, r"(?s)<!--.*", "")


def slim_html(page: Column, attributes: Sequence[str] = HEAVY) -> Column:
    """Without the given attributes in double quotes."""
    return F.regexp_replace(page, rf'\s(?:{"|".join(attributes)})="[^"]*"', "")


def numbers_in(text: Column) -> Column:
    """All numbers, decimals included, as doubles."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)")), lambda x: x.cast("double"))


def ints_in(text: Column) -> Column:
    """All runs of digits as integers; those too large are null."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)")), lambda x: x.try_cast("bigint"))


def first_int(text: Column) -> Column:
    return F.get(ints_in(text), F.lit(0))


def clean_text(text: Column) -> Column:
    """No-break spaces and hyphens made plain, white space single, blank as null."""
    plain = F.regexp_replace(F.translate(text, " ‑", " -"), r"\s+", " ")
    return F.nullif(F.trim(plain), F.lit(""))
