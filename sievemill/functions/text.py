"""Scalar text functions as native column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the 29 code points that str.strip() removes, as a Java character class.
SPACES = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
#: Fixed value: a number with optional dollar sign, thousands, decimals and per cent sign.
NUMBER = r"(?U)\$?\d+(?:,\d{3})*(?:\.\d+)?%?"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), f"^{SPACES}+|{SPACES}+$", "")


def normalise(c: str | Column) -> Column:
    """Stripped and lower-cased: the key of comparisons."""
    return F.lower(strip(c))


def collapse_spaces(c: str | Column) -> Column:
    return strip(F.regexp_replace(_col(c), f"{SPACES}+", " "))


def word_count(c: str | Column) -> Column:
    stripped = strip(c)
    return F.when(stripped == "", 0).otherwise(F.size(F.split(stripped, f"{SPACES}+"))).cast("long")


def numbers(c: str | Column) -> Column:
    """Distinct numeric tokens."""
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(NUMBER), F.lit(0)))


def clean_markdown(c: str | Column) -> Column:
    """Newline runs to two, then tags, script links and skip links out, then stripped; in this order."""
    c = F.regexp_replace(_col(c), r"\n{3,}", "\n\n")
    c = F.regexp_replace(c, r"<[^>]+>", "")
    c = F.regexp_replace(c, r"\[([^\]]+)\]\(javascript:[^)]*\)", "$1")
    c = F.regexp_replace(c, r"Skip to main content\n*", "")
    return strip(c)


def unlink_markdown(c: str | Column) -> Column:
    """Markdown links as their text."""
    return F.regexp_replace(_col(c), r"\[([^\]]+)\]\([^)]*\)", "$1")


def url_part(url: str | Column, kind: str, part: str) -> Column:
    """The numeric id or the slug of a collection or article URL; empty if it is none. kind: collections or articles."""
    return F.regexp_extract(_col(url), rf"/{kind}/(\d+)-(.+?)(?:\?|$|#)", {"id": 1, "slug": 2}[part])


def absolute(href: str | Column, origin: str) -> Column:
    href = _col(href)
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(origin), href))


def strip_query(url: str | Column) -> Column:
    """Up to the first question mark; a fragment before it stays."""
    return F.substring_index(_col(url), "?", 1)


def is_link(href: str | Column, kind: str) -> Column:
    """Collection links start with http or a slash; article links need only their path part."""
    href = _col(href)
    inside = href.contains(f"/{kind}/")
    return inside & (href.startswith("http") | href.startswith("/")) if kind == "collections" else inside


def strip_title(title: str | Column, site: str) -> Column:
    """Without a trailing ` | site...`."""
    return F.regexp_replace(_col(title), rf"(?U)\s*\|\s*{re.escape(site)}.*$", "")


@F.pandas_udf(T.StringType())
def title_case(c: pd.Series) -> pd.Series:
    """Capitals after every non-letter, which initcap does not do."""
    return c.map(lambda s: None if s is None else s.title())


def slug_name(slug: str | Column, names: dict[str, str]) -> Column:
    """The known name of a slug, else the slug with spaces in title case."""
    slug = _col(slug)
    return F.coalesce(lookup(slug, names), title_case(F.replace(slug, F.lit("-"), F.lit(" "))))


def lookup(key: Column, values: dict[str, str]) -> Column:
    """A value of a small literal map, or null."""
    if not values:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.coalesce(key, F.lit("")))


def fill(template: str, **values: Column) -> Column:
    """A template's {name} fields replaced by columns and {{ }} by braces; values are not read again."""
    out, literal = [], ""
    for token in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if token in ("{{", "}}"):
            literal += token[0]
        elif re.fullmatch(r"\{\w+\}", token):
            out += [F.lit(literal), values[token[1:-1]]]
            literal = ""
        else:
            literal += token
    return F.concat(*out, F.lit(literal))


def percent(rate: Column) -> Column:
    return F.format_string("%.1f%%", rate * 100)
