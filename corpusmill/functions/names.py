"""Normalisation of person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import SPACE

# Fixed value: characters stripped from both ends of a name part.
NAME_EDGE = ".,;:!?\"'()-»«›‹„“”‚‘’"


def person_name(name: Column, titles) -> Column:
    """Lower-case name parts without punctuation at the edges and titles.

    The result is the empty string when nothing is left.
    """
    parts = F.transform(F.split(F.lower(name), f"(?U){SPACE}+"), lambda p: F.btrim(p, F.lit(NAME_EDGE)))
    kept = F.filter(parts, lambda p: (p != "") & ~p.isin(list(titles)) if titles else p != "")
    return F.array_join(kept, " ")


def last_word(name: Column) -> Column:
    return F.substring_index(name, " ", -1)
