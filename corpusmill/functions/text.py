"""Cleaning and sampling of raw book texts as column expressions.

Nothing here splits a text into an array: cleaning is a short chain of regular
expression passes, counting and sampling use the native substring functions,
so one text costs a few linear scans inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as a character-class body: the Unicode property plus the four
# ASCII separators, which text readers also treat as space. The same spelling
# is valid in Java and in RE2.
WS = (r"\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# The same for Java, which tests its own property much faster than the list;
# patterns with it start with the flag for Unicode classes.
SPACE = r"[\s\x1c-\x1f]"
SPACE_IN_LINE = r"(?U)[\s\x1c-\x1f&&[^\n]]+"
NON_SPACE = r"(?U)[^\s\x1c-\x1f]+"

# The marker lines around the body of a distributed book file.
START_MARK = rf"(?iU)\*\*\*{SPACE}*START OF (?:THE|THIS) PROJECT GUTENBERG E-?BOOK[^\n]*"
END_MARK = rf"(?iU)\*\*\*{SPACE}*END OF (?:THE|THIS) PROJECT GUTENBERG E-?BOOK"
# Transcription artefacts.
BRACKET_NOTE = r"\[[^\[\]]{0,1000}\]"
SEPARATOR_LINE = r"(?mdU)^[\s\x1c-\x1f*\-.=_~]+$"
MARKUP_CHARS = "_="

BREAK = "\n\n"
# Stands for a paragraph break while single spaces are cleaned up. It counts
# as white space, so after the collapse no text can contain it.
_MARK = "\x1e"


def trim_ws(text: Column) -> Column:
    """Strip every kind of white space, not only blanks, at both ends."""
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+$", "")


def collapse_ws(text: Column) -> Column:
    """Runs of white space become one blank; none is left at the ends."""
    return F.btrim(F.regexp_replace(text, f"(?U){SPACE}+", " "))


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def strip_boilerplate(raw: Column) -> Column:
    """The text between the first start marker line and the first end marker.

    A missing marker stands for the edge of the text; an end marker that comes
    before the end of the start line leaves nothing. Positions are found by
    looking up the matched string, which counts characters exactly as
    ``substring`` does.
    """
    head = F.regexp_extract(raw, START_MARK, 0)
    tail = F.regexp_extract(raw, END_MARK, 0)
    start = F.position(head, raw) + F.length(head) - 1
    stop = F.when(tail == "", F.length(raw)).otherwise(F.position(tail, raw) - 1)
    return F.substr(raw, start + 1, F.greatest(stop - start, F.lit(0)))


def clean_text(text: Column) -> Column:
    """Paragraphs of single-spaced words, separated by one empty line.

    Notes in square brackets become a blank, separator lines and emphasis
    marks go, wrapped lines are joined. A run of white space with at least two
    line feeds is a paragraph break, every other run is a blank.
    """
    out = _swap(text, "\r\n", "\n")
    out = F.regexp_replace(out, BRACKET_NOTE, " ")
    out = F.regexp_replace(out, SEPARATOR_LINE, "")
    for char in MARKUP_CHARS:
        out = _swap(out, char, "")
    out = F.regexp_replace(out, SPACE_IN_LINE, " ")
    # Blanks are single now, so these two leave none next to a line feed.
    out = _swap(_swap(out, " \n", "\n"), "\n ", "\n")
    out = _swap(F.regexp_replace(out, "\n\n+", _MARK), "\n", " ")
    return _swap(F.btrim(out, F.lit(" " + _MARK)), _MARK, BREAK)


def paragraphs(clean: Column) -> Column:
    """The paragraphs of a cleaned text as an array."""
    return F.split(clean, BREAK)


def count_words(text: Column) -> Column:
    """Number of words separated by white space; any text, 0 when empty."""
    return F.regexp_count(text, F.lit(NON_SPACE)).cast("long")


def count_clean_words(clean: Column) -> Column:
    """The same for a cleaned text, from its length: words are one blank or
    one paragraph break apart."""
    spaced = _spaced(clean)
    return F.when(clean == "", 0).otherwise(_blanks(spaced) + 1).cast("long")


def _spaced(clean: Column) -> Column:
    """One blank before every word but the first, breaks kept before it."""
    return _swap(clean, BREAK, BREAK + " ")


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(_swap(text, " ", ""))


def with_sample(df: DataFrame, clean: str, *, skip_fraction: float, sample_words: int,
                out: str = "sample") -> DataFrame:
    """Add a passage of exactly ``sample_words`` words of a cleaned text.

    Whole paragraphs are skipped while the words before them are fewer than
    ``int(words * skip_fraction)``; the passage starts with the next one and
    keeps its paragraph breaks. Null when too few words are left.
    """
    t, skip, head, cut, rest, part = (f"__{n}" for n in ("text", "skip", "head", "cut", "rest", "part"))
    col = F.col
    steps = df.withColumn(t, _spaced(col(clean)))
    steps = steps.withColumn(skip, F.when(col(t) == "", 0).otherwise(
        ((_blanks(col(t)) + 1).cast("double") * F.lit(float(skip_fraction))).cast("int")))
    # The passage that ends with the last word to skip, then the break after it.
    steps = steps.withColumn(head, F.length(F.call_function("substring_index", col(t), F.lit(" "), col(skip))))
    steps = steps.withColumn(cut, F.when(col(skip) <= 0, 0).otherwise(F.nullif(
        F.position(F.lit(BREAK + " "), col(t), F.greatest(col(head) - 1, F.lit(1))), F.lit(0)) + len(BREAK)))
    steps = steps.withColumn(rest, F.substr(col(t), col(cut) + 1))
    steps = steps.withColumn(part, F.substring_index(col(rest), " ", sample_words))
    enough = (col(part) != "") & (_blanks(col(part)) + 1 == sample_words)
    return (steps.withColumn(out, F.when(enough, F.replace(
                F.rtrim(col(part), F.lit("\n")), F.lit(BREAK + " "), F.lit(BREAK))))
            .drop(t, skip, head, cut, rest, part))
