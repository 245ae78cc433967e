"""Catalog fields as column expressions: people, keywords, titles, epochs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import WS, collapse_ws, trim_ws

# Fixed values: "[Role]" and ", birth-death" at the end of an author entry;
# either year may be missing or followed by a question mark.
ROLE = r"\[([^\]]+)\]"
LIFESPAN = rf",[{WS}]*([0-9]{{1,4}})?\??[{WS}]*-[{WS}]*([0-9]{{1,4}})?\??[{WS}]*$"
# First entry of a list separated by semicolons that is not blank.
FIRST_ENTRY = rf"^(?:[{WS}]*;)*([^;]*)"
NOT_WORD = r"[^\p{L}\p{N}_]"
IN_WORD = r"[\p{L}\p{N}_]"


def _year(entry: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(entry, LIFESPAN, group), F.lit("")).cast("int")


def parse_author(entry: Column) -> Column:
    """``struct(name, role, birth_year, death_year)`` of one author entry."""
    plain = F.regexp_replace(entry, ROLE, "")
    return F.struct(
        trim_ws(F.regexp_replace(plain, LIFESPAN, "")).alias("name"),
        F.nullif(F.regexp_extract(entry, ROLE, 1), F.lit("")).alias("role"),
        _year(plain, 1).alias("birth_year"),
        _year(plain, 2).alias("death_year"),
    )


def split_authors(field: Column) -> Column:
    """Every entry of the author field that is not blank, parsed, in order."""
    entries = F.filter(F.split(field, ";"), lambda e: trim_ws(e) != "")
    return F.transform(entries, parse_author)


def first_author(field: Column) -> Column:
    """The first entry whatever its role; an empty name when there is none.

    Same as ``split_authors(field)[0]`` without building the array.
    """
    return parse_author(F.regexp_extract(field, FIRST_ENTRY, 1))


def _escape(word: str) -> str:
    return re.sub(r"([\\^$.|?*+()\[\]{}\-])", r"\\\1", word)


def keyword_pattern(keywords) -> str:
    """One alternation; a keyword follows a word boundary.

    Before a word character the boundary is the start of the text or another
    kind of character, before any other character it is a word character.
    """
    inner = [_escape(k) for k in keywords if re.match(r"\w", k)]
    outer = [_escape(k) for k in keywords if not re.match(r"\w", k)]
    parts = []
    if inner:
        parts.append(f"(^|{NOT_WORD})(" + "|".join(inner) + ")")
    if outer:
        parts.append(f"{IN_WORD}(" + "|".join(outer) + ")")
    return "|".join(parts)


def contains_keyword(text: Column, keywords) -> Column:
    """True when a word of ``text`` starts with one of the keywords."""
    if not keywords:
        return F.lit(False)
    return F.lower(text).rlike(keyword_pattern(keywords))


def title_text(title: Column) -> Column:
    """The title on one line."""
    return collapse_ws(title)


def title_key(title: Column) -> Column:
    """Lower-case words of a title, for finding duplicate editions."""
    return F.btrim(F.regexp_replace(F.lower(title), f"{NOT_WORD}+", " "))


def epoch_label(year: Column, epochs) -> Column:
    """The first bin whose last year is not before ``year``; null outside.

    The bin is the number of limits below the year, so the year, which is
    parsed from text, is read once.
    """
    limits, names, highest = [epochs.floor - 1], [F.lit(None).cast("string")], epochs.floor - 1
    for name, last in epochs.bins:
        highest = max(highest, last)
        limits.append(highest)
        names.append(F.lit(name))
    below = F.size(F.filter(F.array(*[F.lit(v) for v in limits]), lambda v: v < year))
    return F.get(F.array(*names), below)
