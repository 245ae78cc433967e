"""Secret scans in native functions: fixed patterns, and a randomness test battery for any other token.

A token may be a secret if its characters look drawn at random. Its encoding is
inferred (hex, base 32, base 62, base 64); within it a chi-squared test of
uniformity, a runs test and a test of serial correlation must not contradict
chance. The discovery itself rests on what words are not: they change seldom between
lower case, upper case and digits, and their letters are not equally frequent.
The chance of so many changes in a word, bounded from above, and that of letters
so much likelier in the encoding than in the words of all texts are put together
(Fisher) to the token's p-value, and Benjamini-Hochberg control among all tokens
of its encoding and about its length in the whole table decides. A token of one
class of characters is never taken for random.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The three kinds, in order, as patterns whose matches may be too short, and their least length.
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = rf"((?i:{KEYWORDS}))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
KINDS = (("assign", ASSIGN, 6), ("access", r"AKIA[A-Z0-9]{16,}", 20), ("hex", r"[0-9a-f]{24,}", 24))
ADDED = "random"

HEX, B32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


@dataclass(frozen=True)
class Secrets:
    """``change`` is how often text changes its class of letters; ``rate`` the false discoveries; ``z`` the tests' bound."""

    shortest: int = 16
    change: float = 0.1
    rate: float = 1e-3
    z: float = 4.0
    mark: str = "[secret]"


def running(values: Column, block: int = 256) -> Column:
    """Sums of all values before each, by blocks, since growing one long array would be quadratic."""
    def inside(part: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("s"))
        return F.aggregate(part, start, lambda a, x: F.struct(
            F.concat(a["out"], F.array(a["s"])).alias("out"), (a["s"] + x).alias("s")))["out"]

    blocks = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(block)), lambda i: F.slice(values, i, block))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
    joined = F.flatten(F.zip_with(blocks, inside(totals), lambda b, o: F.transform(inside(b), lambda x: x + o)))
    return F.when(F.size(values) > 0, joined).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``start, end, found`` of every match, in code points; ``found`` is the group."""
    long = lambda c: F.length(c).cast("bigint")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    before = running(F.zip_with(gaps, hits, lambda g, h: long(g) + long(h)))
    starts = F.zip_with(before, gaps, lambda b, g: b + long(g))
    spans = F.zip_with(starts, hits, lambda s, h: F.struct(s.alias("start"), (s + long(h)).alias("end"), h.alias("hit")))
    if not group:
        return spans
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.zip_with(spans, groups, lambda s, g: F.struct(s["start"].alias("start"), s["end"].alias("end"), g.alias("hit")))


def _kept(found: Column, place: int, least: int) -> Column:
    long_enough = F.filter(found, lambda m: F.length(m["hit"]) >= least)
    return F.transform(long_enough, lambda m: F.struct(
        m["start"].alias("start"), F.lit(place).alias("kind"), m["end"].alias("end")))


def base_spans(text: str) -> list[Column]:
    """Per kind the array of ``start, kind, end``; the kind by its place in the list."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return [F.when(F.col(text).rlike(pattern), _kept(matches(F.col(text), pattern, 2 if place == 0 else 0), place, least))
            .otherwise(none) for place, (_, pattern, least) in enumerate(KINDS)]


def changes(token: Column) -> Column:
    """How often the token goes from one class of characters to another."""
    for pattern, one in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[+/_-]+", "-")):
        token = F.regexp_replace(token, pattern, one)
    return F.length(token) - 1


def log_p(n: Column, k: Column, change: float) -> Column:
    """ln of an upper bound (Chernoff) on the chance of k or more changes in n - 1 places."""
    m = (n - 1).cast("double")
    x = k / m
    left = F.when(x < 1, (1 - x) * F.log((1 - x) / (1 - change))).otherwise(0.0)
    return F.when(x > change, -m * (x * F.log(x / change) + left)).otherwise(0.0)


def letter_logs(docs: DataFrame) -> DataFrame:
    """One row: ln of the share of each letter among the letters a to z of all texts, in either case."""
    low = docs.select(F.lower(F.col("text").cast("string")).alias("low"))
    letters = "abcdefghijklmnopqrstuvwxyz"
    count = lambda c: F.octet_length("low") - F.octet_length(F.replace("low", F.lit(c), F.lit("")))
    sums = low.agg(*(F.coalesce(F.sum(count(c).cast("bigint")), F.lit(0)).alias(c) for c in letters))
    total = sum((F.col(c) for c in letters), F.lit(0))
    return sums.select(F.array(*(F.log((F.col(c) + 1) / (total + len(letters))) for c in letters)).alias("_letters"))


def letters_log_p(token: Column, logs: Column) -> Column:
    """ln of an upper bound (Markov) on the chance that words have letters so much likelier when drawn evenly.

    Evenly means from a to f for half the weight, and from a to z for the other.
    """
    own = F.split(F.lower(F.regexp_replace(token, "[^A-Za-z]", "")), "")
    log = F.aggregate(own, F.lit(0.0), lambda a, c: a + F.coalesce(F.get(logs, F.ascii(c) - 97), F.lit(0.0)))
    n = F.length(F.regexp_replace(token, "[^A-Za-z]", ""))
    each = F.when(encoding(token) == 0, F.log(F.lit(6.0))).otherwise(F.log(F.lit(26.0)))
    return F.least(F.lit(0.0), log + n * each + F.log(F.lit(2.0)))


def token_log_p(token: Column, logs: Column, change: float) -> Column:
    """ln of the p-value, up to the next 64th; 0 for a token without changes."""
    k = changes(token)
    both = F.array(log_p(F.length(token), k, change) + letters_log_p(token, logs))
    fisher = F.element_at(F.transform(both, lambda x: x + F.log(1 - x)), 1)
    return F.when(k > 0, F.least(F.lit(0.0), F.ceil(64 * fisher) / 64)).otherwise(0.0)


def encoding(token: Column) -> Column:
    """0 hex, 1 base 32, 2 base 62, 3 base 64."""
    return F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 0).when(token.rlike("^[A-Z2-7]+$"), 1).when(
        token.rlike("^[A-Za-z0-9]+$"), 2).otherwise(3)


def _alphabet(token: Column) -> tuple[Column, Column]:
    """The token in its encoding's letters, and the encoding's alphabet."""
    plain = F.translate(token, "-_", "+/")
    hexed = token.rlike("^([0-9a-f]+|[0-9A-F]+)$")
    b32 = token.rlike("^[A-Z2-7]+$")
    b62 = token.rlike("^[A-Za-z0-9]+$")
    letters = F.when(hexed, F.lit(HEX)).when(b32, F.lit(B32)).when(b62, F.lit(B64[:62])).otherwise(F.lit(B64))
    return F.when(hexed, F.lower(token)).otherwise(plain), letters


def looks_random(token: Column, z: float) -> Column:
    """Whether no test of the battery contradicts a uniform, independent choice of letters."""
    plain, letters = _alphabet(token)
    n, size = F.length(plain).cast("double"), F.length(letters).cast("double")
    places = F.transform(F.split(plain, ""), lambda c: F.instr(letters, c).cast("double") - 1)
    ordered = F.array_join(F.array_sort(F.split(plain, "")), "")
    counts = F.transform(F.regexp_extract_all(ordered, F.lit(r"(.)\1*"), F.lit(0)), lambda r: F.length(r).cast("double"))
    zero = F.lit(0.0)
    # Chi-squared of uniformity, with the exact mean and variance for short tokens.
    chi = size / n * F.aggregate(counts, zero, lambda a, x: a + x * x) - n
    z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    # Runs of letters in the lower and upper half of the alphabet.
    half = F.array_join(F.transform(places, lambda x: F.when(x < size / 2, "0").otherwise("1")), "")
    ones = F.length(F.replace(half, F.lit("0"), F.lit(""))).cast("double")
    runs = F.regexp_count(half, F.lit("0+|1+")).cast("double")
    p = 2 * ones * (n - ones) / n
    z_runs = (runs - 1 - p) / F.sqrt(F.greatest(p * (p - 1) / (n - 1), F.lit(1e-9)))
    # Correlation of neighbours.
    mean = F.aggregate(places, zero, lambda a, x: a + x) / n
    var = F.aggregate(places, zero, lambda a, x: a + x * x) / n - mean * mean
    pairs = F.zip_with(F.slice(places, F.lit(1), F.length(plain) - 1), F.slice(places, F.lit(2), F.length(plain) - 1),
                       lambda x, y: x * y)
    cov = F.aggregate(pairs, zero, lambda a, x: a + x) / (n - 1) - mean * mean
    z_serial = cov / F.greatest(var, F.lit(1e-9)) * F.sqrt(n)
    return (z_chi <= z) & (ones > 0) & (ones < n) & (F.abs(z_runs) <= z) & (F.abs(z_serial) <= z)


def candidates(text: str, p: Secrets, logs: str = "_letters") -> Column:
    """All long tokens of a text with their stratum and ln p."""
    pattern = rf"[A-Za-z0-9+/_-]{{{p.shortest},}}"
    found = F.transform(matches(F.col(text), pattern), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), stratum(m["hit"]).alias("s"),
        token_log_p(m["hit"], F.col(logs), p.change).alias("lp"), m["hit"].alias("token")))
    kind = "array<struct<start:bigint,end:bigint,s:int,lp:double,token:string>>"
    return F.when(F.col(text).rlike(pattern), found).otherwise(F.array().cast(kind))


def stratum(token: Column) -> Column:
    """Tokens of one encoding and about the same length: each length up to 64, then by eighths of a power of two."""
    n = F.length(token)
    return encoding(token) * 1000 + F.when(n <= 64, n).otherwise(F.floor(8 * F.log2(n.cast("double"))).cast("int") + 64)


def thresholds(docs: DataFrame, p: Secrets) -> DataFrame:
    """One row: the largest accepted ln p of each stratum, as a map, and the letters' logarithms.

    Only numbers of tokens by (stratum, ln p) are shuffled, added up before.
    """
    pattern = F.lit(rf"[A-Za-z0-9+/_-]{{{p.shortest},}}")
    letters = letter_logs(docs)
    tokens = docs.select(F.explode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("t"))
    tokens = tokens.crossJoin(F.broadcast(letters))
    kinds = tokens.select(stratum(F.col("t")).alias("s"), token_log_p(F.col("t"), F.col("_letters"), p.change).alias("lp")
                          ).groupBy("s", "lp").agg(F.count("*").alias("c"))
    below = Window.partitionBy("s").orderBy("lp")
    whole = Window.partitionBy("s")
    ranked = kinds.select("s", "lp", F.sum("c").over(below).alias("r"), F.sum("c").over(whole).alias("m"))
    good = ranked.where(F.col("lp") <= F.log(p.rate * F.col("r") / F.col("m"))).groupBy("s").agg(F.max("lp").alias("lp"))
    return good.agg(F.map_from_entries(F.collect_list(F.struct("s", "lp"))).alias("_accepted")).crossJoin(F.broadcast(letters))


def with_spans(docs: DataFrame, p: Secrets) -> DataFrame:
    """``docs`` with ``_base`` and ``_all``: sorted spans ``start, kind, end`` of every text (null: empty).

    Added spans never overlap a base span. Kinds are numbered as listed, the
    added one last. Texts are scanned for the letters, the thresholds and the
    spans and never shuffled.
    """
    names = docs.columns
    accepted = thresholds(docs.select("text"), p)
    rows = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit(""))).crossJoin(F.broadcast(accepted))
    rows = rows.withColumns({f"_kind{i}": c for i, c in enumerate(base_spans("_text"))}
                            | {"_tokens": candidates("_text", p)})
    rows = rows.withColumn("_base", F.array_sort(F.concat("_kind0", "_kind1", "_kind2")))
    unlikely = F.filter("_tokens", lambda t: t["lp"] <= F.coalesce(
        F.element_at("_accepted", t["s"]), F.lit(float("-inf"))))
    rows = rows.withColumn("_unlikely", unlikely)
    own = F.filter("_unlikely", lambda t: looks_random(t["token"], p.z) & ~F.exists(
        "_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    added = F.transform(own, lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), t["end"].alias("end")))
    rows = rows.withColumn("_all", F.when(F.size("_unlikely") > 0, F.array_sort(F.concat("_base", added)))
                           .otherwise(F.col("_base")))
    return rows.select(*names, "_kind0", "_kind1", "_kind2", "_base", "_all")


def listed(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*(F.lit(k) for k, _, _ in KINDS), F.lit(ADDED))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, p: Secrets = Secrets()) -> DataFrame:
    """Numbers, digest and list of the secrets' spans of every row of ``docs`` (doc_id, text).

    Null and empty texts have none: numbers 0, an empty list and its digest.
    Positions count code points from 0, the end behind the last. Repeated rows
    give repeated results; an empty table gives no rows.
    """
    rows = with_spans(docs.select("doc_id", "text"), p)
    return rows.select(
        "doc_id", *(F.size(f"_kind{i}").cast("long").alias(f"n_{k}") for i, (k, _, _) in enumerate(KINDS)),
        F.sha2(listed("_base"), 256).alias("base_sha256"), listed("_all").alias("spans"),
        (F.size("_all") - F.size("_base")).cast("long").alias("n_random"))


def redact(docs: DataFrame, p: Secrets = Secrets(), text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by a mark, and the number of characters to match where there is one.

    Overlapping spans are replaced together. Rows without secrets stay as they are.
    """
    rows = with_spans(docs, p)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    body = lambda a, s: F.substr(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
    done = F.aggregate("_all", start, lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).when((s["start"] == a["at"]) & (a["at"] > 0), a["out"])
        .otherwise(F.concat(a["out"], body(a, s), F.lit(p.mark))).alias("out")))
    rows = rows.withColumn("_done", F.when(F.size("_all") > 0, done))
    rest = F.substr(F.col(text), (F.col("_done.at") + 1).cast("int"))
    rows = rows.withColumn(text, F.when(F.col("_done").isNotNull(), F.concat("_done.out", rest)).otherwise(F.col(text)))
    if n_chars in docs.columns:
        rows = rows.withColumn(n_chars, F.when(F.col("_done").isNotNull(), F.length(text).cast(docs.schema[n_chars].dataType))
                               .otherwise(F.col(n_chars)))
    return rows.select(*docs.columns)
