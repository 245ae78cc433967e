"""Words, sentences and style measures of one text as column expressions.

All measures are narrow: they look at one text and need no shuffle. Tokens from
another annotator go through ``operators.tokens`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import WS

WORD = r"[\p{L}\p{M}\p{N}]+(?:['’-][\p{L}\p{M}\p{N}]+)*"
SENTENCE_END = rf"[.!?…]+[»«“”’\")]*([{WS}]+|$)"
# Abbreviations, in any case, whose dot ends no sentence.
ABBREVIATIONS = ["hr", "hrn", "fr", "frl", "dr", "prof", "st", "mr", "mrs", "ms", "mme", "mlle", "sr", "sra"]
# A dot after one of these, an initial or a small ordinal number stays inside the sentence.
_INNER = "|".join(f"[{a[0].upper()}{a[0]}]{a[1:]}" for a in ABBREVIATIONS)
INNER_DOT = rf"(^|[^\p{{L}}\p{{M}}\p{{N}}])((?:{_INNER})|\p{{Lu}}|[0-9]{{1,2}})\."
# The same dots, found by themselves: only dots are looked at closely, and what is before one is left for the next.
_DOT_INSIDE = rf"\.(?<=(?:^|[^\p{{L}}\p{{M}}\p{{N}}])(?:{_INNER}|\p{{Lu}}|[0-9]{{1,2}})\.)"
NO_END = "\ue000"  # stands for such a dot while sentences are cut
SENTENCE_BREAK = "\x1e"
BLANK_LINE = rf"\n[{WS}]*\n"
CAPITALISED = r"\p{Lu}[\p{L}\p{M}'’-]*"


def words(text: Column) -> Column:
    """The words of a text; punctuation and space are never words."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _parts(text: Column) -> Column:
    """The text cut at closing marks and blank lines; a single line break does not end a sentence."""
    text = F.regexp_replace(text, _DOT_INSIDE, NO_END)
    text = F.regexp_replace(text, BLANK_LINE, SENTENCE_BREAK)
    parts = F.split(F.regexp_replace(text, SENTENCE_END, SENTENCE_BREAK), f"{SENTENCE_BREAK}+")
    return F.transform(parts, lambda s: F.replace(s, F.lit(NO_END), F.lit(".")))


def sentences(text: Column) -> Column:
    """The sentences of a text that contain a word."""
    return F.filter(_parts(text), lambda s: s.rlike(WORD))


def sentence_lengths(text: Column) -> Column:
    """Words per sentence, sentences without a word left out."""
    return F.filter(F.transform(_parts(text), lambda s: F.regexp_count(s, F.lit(WORD))), lambda n: n > 0)


def array_median(values: Column) -> Column:
    """Exact median of an array of numbers, null when it is empty.

    ``values`` is read several times, so it should be a column of its own.
    """
    ordered, n = F.sort_array(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / F.lit(2.0))


def standardised_ttr(lower_words: Column, window: int, strict: bool = False) -> Column:
    """Mean share of distinct words over complete windows.

    Null when the text is shorter than one window, or an error if ``strict``.
    """
    n = F.floor(F.size(lower_words) / F.lit(window)).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    total = F.aggregate(starts, F.lit(0), lambda acc, i: acc + F.size(
        F.array_distinct(F.slice(lower_words, i * window + 1, F.lit(window)))))
    share = F.when(n > 0, total / (n * F.lit(float(window))))
    return share.otherwise(F.raise_error(F.lit(f"text shorter than one window of {window} words"))) if strict else share


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _listed(words_of_lang: list[str]):
    return lambda w: w.isin(words_of_lang)


def function_words(lower_words: Column, lang: Column, lexicon) -> Column:
    """How many words the closed-class lexicon of the language lists."""
    by_lang: dict[str, list[str]] = {}
    for code, word, _ in lexicon:
        by_lang.setdefault(code, []).append(word)
    hits = F.lit(0)
    for code, listed in by_lang.items():
        count = F.size(F.filter(lower_words, _listed(listed)))
        hits = F.when(lang == code, count).otherwise(hits)
    return hits


def with_style(df: DataFrame, text: str, *, window: int, lexicon, lang: str = "lang",
               strict: bool = False) -> DataFrame:
    """Add ``n_words, median_sentence_length, sttr, function_word_ratio``.

    The word list and the sentence lengths are columns of their own first, so
    each is extracted once however often it is read.
    """
    w, s = "__words", "__lengths"
    out = df.withColumns({w: words(F.lower(F.col(text))), s: sentence_lengths(F.col(text))})
    return out.withColumns({
        "n_words": F.size(w).cast("long"),
        "median_sentence_length": array_median(F.col(s)),
        "sttr": standardised_ttr(F.col(w), window, strict),
        "function_word_ratio": guarded_ratio(function_words(F.col(w), F.col(lang), lexicon), F.size(w)),
    }).drop(w, s)


def cue_pattern(titles) -> str:
    """A title, an optional particle, one or two capitalised words."""
    cues = "|".join(sorted((t[:1].upper() + t[1:] for t in titles), reverse=True))
    return rf"(?:^|[^\p{{L}}\p{{M}}\p{{N}}])((?:{cues})\.? (?:(?:von|van|zu|de) )?{CAPITALISED}(?: {CAPITALISED})?)"


def cue_mentions(text: Column, titles) -> Column:
    """Person mentions that a title introduces, in order of appearance."""
    return F.regexp_extract_all(text, F.lit(cue_pattern(titles)), F.lit(1))
