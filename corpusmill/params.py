"""Parameters of the jobs and their dimension tables.

The word lists, year limits and sizes below are fixed values: results are only
comparable when they are the same on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Words that mark a book as drama, verse or non-fiction.
EXCLUDE_KEYWORDS = [
    "drama", "schauspiel", "trauerspiel", "lustspiel", "tragödie", "komödie", "posse", "plays",
    "theater", "oper", "libretto",
    "gedicht", "poetry", "poems", "lyrik", "ballade", "lieder", "sonett", "epigramm", "verse", "epos",
    "briefe", "letters", "correspondence", "biography", "history and criticism", "aufsätze", "essays",
    "reden", "tagebuch", "diaries", "sämtliche werke", "gesammelte werke", "anthologie", "anthologies",
    "reise", "travel",
]

# Titles and forms of address that are not part of a name.
PERSON_TITLES = [
    "herr", "hr", "herrn", "frau", "fr", "fräulein", "frl", "freiherr", "freiherrin", "fürst", "fürstin",
    "graf", "gräfin", "baron", "baronin", "doktor", "dr", "professor", "prof", "pastor", "onkel", "tante",
    "könig", "königin", "prinz", "prinzessin", "sankt", "st", "von", "der", "die", "den", "dem",
]

# Universal tags that count as function words.
FUNCTION_POS = ["DET", "ADP", "CCONJ", "SCONJ"]

# Closed-class words by language and tag, one string per list.
FUNCTION_WORDS = {
    ("de", "DET"): "der die das den dem des ein eine einen einem einer eines kein keine keinen keinem keiner keines dieser diese dieses diesen diesem jeder jede jedes jeden jedem jener jene jenes jenen jenem welcher welche welches mein meine meinen meinem meiner dein deine sein seine seinen seinem seiner ihr ihre ihren ihrem ihrer unser unsere euer eure alle einige manche",
    ("de", "ADP"): "in an auf aus bei mit nach von zu vor über unter durch für gegen ohne um im am zum zur vom beim ins ans aufs seit wegen während neben hinter bis zwischen außer statt trotz gegenüber innerhalb außerhalb",
    ("de", "CCONJ"): "und oder aber denn sondern sowie weder noch",
    ("de", "SCONJ"): "dass daß weil wenn als ob obwohl nachdem bevor da damit indem sobald solange obgleich falls sodass ehe",
    ("en", "DET"): "the a an this that these those each every no some any my your his her its our their which what all both another",
    ("en", "ADP"): "of in on at by for with from into over under through between to about before after against during without within among upon toward towards behind beside near since until across along around",
    ("en", "CCONJ"): "and or but nor yet",
    ("en", "SCONJ"): "because if while although unless whether than as though lest once",
    ("fr", "DET"): "le la les un une des du ce cet cette ces mon ma mes ton ta tes son sa ses notre nos votre vos leur leurs chaque quelque quelques aucun aucune",
    ("fr", "ADP"): "de à dans par pour sur avec sans sous chez entre vers avant après depuis pendant contre en au aux malgré parmi",
    ("fr", "CCONJ"): "et ou mais ni car",
    ("fr", "SCONJ"): "que si quand lorsque puisque comme quoique",
    ("es", "DET"): "el la los las un una unos unas este esta estos estas ese esa esos esas aquel aquella mi tu su mis tus sus cada algún alguna ningún ninguna",
    ("es", "ADP"): "de en a por para con sin sobre entre desde hasta hacia ante bajo contra según durante tras al del",
    ("es", "CCONJ"): "y e o u pero ni sino",
    ("es", "SCONJ"): "que si cuando porque aunque como mientras pues",
}


@dataclass(frozen=True)
class Epochs:
    """Ordered bins over the death year: ``floor <= year <= last of the bin``."""

    # Lower limit and last year of every epoch, oldest first.
    floor: int = 1720
    bins: tuple[tuple[str, int], ...] = (("Goethezeit", 1860), ("Realismus", 1910), ("Moderne", 1960))

    @property
    def order(self) -> list[str]:
        return [name for name, _ in self.bins]


@dataclass(frozen=True)
class Selection:
    """Catalog filters and corpus quotas."""

    language: str = "de"
    locc: str = "PT"
    keywords: tuple[str, ...] = tuple(EXCLUDE_KEYWORDS)
    max_per_author: int = 3
    max_per_epoch: int = 120
    min_words: int = 15000
    seed: int = 42


@dataclass(frozen=True)
class Sampling:
    """Which passage of a text is analysed."""

    skip_fraction: float = 0.1
    sample_words: int = 10000


@dataclass(frozen=True)
class Style:
    """Settings of the four features."""

    window: int = 1000
    pos: tuple[str, ...] = tuple(FUNCTION_POS)
    titles: tuple[str, ...] = tuple(PERSON_TITLES)
    min_mentions: int = 2


@dataclass(frozen=True)
class Evaluation:
    """Settings of the classification experiment."""

    test_folds: int = 5
    cv_folds: int = 5
    seed: int = 42
    repeats: int = 30
    trees: int = 300
    min_leaf: int = 2
    max_iter: int = 1000


@dataclass(frozen=True)
class Settings:
    selection: Selection = field(default_factory=Selection)
    epochs: Epochs = field(default_factory=Epochs)
    sampling: Sampling = field(default_factory=Sampling)
    style: Style = field(default_factory=Style)
    evaluation: Evaluation = field(default_factory=Evaluation)


def epoch_table(spark: SparkSession, epochs: Epochs) -> DataFrame:
    """``(ord, name, lo, hi)`` with both limits inclusive.

    A bin that an earlier one already covers stays in the table as an empty
    range, so the first matching bin in list order wins.
    """
    rows, lo = [], epochs.floor
    for i, (name, last) in enumerate(epochs.bins):
        rows.append((i, name, lo, last))
        lo = max(lo, last + 1)
    return spark.createDataFrame(rows, "ord int, name string, lo int, hi int")


def order_table(spark: SparkSession, order: list[str], name: str = "name") -> DataFrame:
    """``(ord, <name>)``: the display order of a class column."""
    return spark.createDataFrame(list(enumerate(order)), f"ord int, {name} string")


def keyword_table(spark: SparkSession, keywords) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keywords], "keyword string")


def lexicon(pos=tuple(FUNCTION_POS)) -> list[tuple[str, str, str]]:
    """``(lang, word, upos)`` for the wanted tags."""
    return [(lang, word, tag) for (lang, tag), words in FUNCTION_WORDS.items() if tag in pos
            for word in words.split()]


def lexicon_table(spark: SparkSession, pos=tuple(FUNCTION_POS)) -> DataFrame:
    return spark.createDataFrame(lexicon(pos), "lang string, word string, upos string")
