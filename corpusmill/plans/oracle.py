"""The same results in plain SQL, for checking.

Where it can, the SQL takes another road than the Spark query: rows and window
functions where Spark uses string functions or arrays, whole-table ranks where
Spark works in buckets, training rows repeated per fold where Spark combines
statistics.
"""

from corpusmill.functions.catalog import LIFESPAN, NOT_WORD
from corpusmill.functions.names import NAME_EDGE
from corpusmill.functions.text import BRACKET_NOTE, WS
from corpusmill.functions.tokens import BLANK_LINE, INNER_DOT, NO_END, SENTENCE_BREAK, SENTENCE_END, WORD, cue_pattern
from corpusmill.operators.evaluate import BASELINE, CENTROID, GROUPED, LOGISTIC, RANDOM, pred_column
from corpusmill.params import PERSON_TITLES, lexicon
from corpusmill.plans import derived
from corpusmill.plans.registry import (CHAIN, CLASSES, EPOCHS, EV, FEATURES, FLAGS, LONG_KEYWORDS, MEASURES, NAME_PATTERNS,
                                       SEL, SETTINGS, STYLE)
from corpusmill.sources.tables import FEATURE_COLUMNS

ORACLE: dict[str, str] = {}


def q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


DOCS = "documents"
CATALOG = f"catalog AS ({derived.CATALOG.format(documents=DOCS)})"
CAT = CATALOG + """,
cat AS (SELECT CAST(text_no AS BIGINT) AS id, coalesce(type, '') AS type, coalesce(language, '') AS language,
  coalesce(title, '') AS title, coalesce(authors, '') AS authors, coalesce(subjects, '') AS subjects,
  coalesce(locc, '') AS locc, coalesce(bookshelves, '') AS bookshelves FROM catalog)"""
BOOKS = f"books AS ({derived.BOOKS.format(documents=DOCS)})"

# Catalog

C_PROSE = f"type = 'Text' AND language = {q(SEL.language)}"
C_CLASS = f"position({q(SEL.locc)} IN locc) > 0"
C_ROLE = "position('Translator' IN authors) = 0"
C_WORDS = "(" + " AND ".join(
    f"NOT regexp_matches(lower(title || ' ' || subjects || ' ' || bookshelves), {q(f'(^|{NOT_WORD})' + k)})"
    for k in SEL.keywords) + ")"

IN_WORD = r"[\p{L}\p{N}_]"
C_LONG = "(" + " AND ".join(
    f"NOT regexp_matches(lower(title || ' ' || subjects || ' ' || bookshelves), "
    f"{q((f'(^|{NOT_WORD})' if k[0].isalnum() else IN_WORD) + k)})" for k in LONG_KEYWORDS) + ")"

# Every author entry as a row; pos counts the entries that are not blank.
PEOPLE = f"""entries AS (
  SELECT id, i, e FROM (SELECT id, unnest(str_split(authors, ';')) AS e,
    generate_subscripts(str_split(authors, ';'), 1) AS i FROM cat) WHERE {trim_ws('e')} <> ''),
plain AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS pos,
  nullif(regexp_extract(e, '\\[([^\\]]+)\\]', 1), '') AS role,
  {trim_ws(r"regexp_replace(e, '\[[^\]]+\]', '', 'g')")} AS p FROM entries),
people AS (SELECT id, CAST(pos AS INTEGER) AS pos, role,
  {trim_ws(f"regexp_replace(p, {q(LIFESPAN)}, '')")} AS name,
  CAST(nullif(regexp_extract(p, {q(LIFESPAN)}, 1), '') AS INTEGER) AS birth_year,
  CAST(nullif(regexp_extract(p, {q(LIFESPAN)}, 2), '') AS INTEGER) AS death_year FROM plain)"""
EPOCH = f"CASE WHEN death_year < {EPOCHS.floor} THEN NULL " + " ".join(
    f"WHEN death_year <= {last} THEN {q(name)}" for name, last in EPOCHS.bins) + " END"
KEY = f"trim(regexp_replace(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}_{WS}]', ' ', 'g'), '[{WS}]+', ' ', 'g'))"
LABELLED = f"""labelled AS (
  SELECT c.id, {collapse_ws('c.title')} AS title, a.name AS author, a.birth_year, a.death_year, {EPOCH} AS epoch
  FROM cat c JOIN people a ON a.id = c.id AND a.pos = 0
  WHERE {C_PROSE} AND {C_CLASS} AND {C_ROLE} AND {C_WORDS} AND {EPOCH} IS NOT NULL)"""
CANDIDATES = f"""keyed AS (SELECT *, {KEY} AS title_key FROM labelled),
candidates AS (SELECT id, title, author, birth_year, death_year, epoch,
  md5(CAST(id AS VARCHAR) || ':{SEL.seed}') AS shuffle_key
  FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM keyed o WHERE o.author = k.author AND o.title_key = k.title_key
    AND o.id < k.id))"""
ALL_CANDIDATES = (CAT, PEOPLE, LABELLED, CANDIDATES)

ORACLE["catalog_scan"] = with_(CATALOG, select="""
SELECT text_no, type, title, language, authors, coalesce(subjects, '') AS subjects, locc,
  coalesce(bookshelves, '') AS bookshelves FROM catalog""")
ORACLE["null_to_empty"] = with_(CATALOG, select="""
SELECT text_no, coalesce(subjects, '') AS subjects, coalesce(bookshelves, '') AS bookshelves FROM catalog""")
for name, condition in (("type_language_filter", C_PROSE), ("class_filter", C_CLASS), ("role_exclusion", C_ROLE),
                        ("keyword_exclude", C_WORDS), ("keyword_exclude_table", C_LONG)):
    ORACLE[name] = with_(CAT, select=f"SELECT id FROM cat WHERE {condition}")
ORACLE["keyword_texts"] = "SELECT doc_id, (" + " OR ".join(
    f"regexp_matches(lower(text), {q(f'(^|{NOT_WORD})' + k)})" for k in ("the", "und ", "tion")) + ") AS hit FROM documents"
ORACLE["parse_authors"] = with_(CAT, PEOPLE, select="SELECT id, pos, name, role, birth_year, death_year FROM people")
ORACLE["first_author_label"] = with_(CAT, PEOPLE, select=f"""
SELECT id, name AS author, birth_year, death_year, {EPOCH} AS epoch FROM people
WHERE pos = 0 AND {EPOCH} IS NOT NULL""")
ORACLE["epoch_label_join"] = with_(CAT, PEOPLE, select=f"SELECT id, death_year, {EPOCH} AS epoch FROM people WHERE pos = 0")
ORACLE["title_keys"] = with_(CAT, select=f"""
SELECT id, title, {KEY} AS title_key FROM (SELECT id, {collapse_ws('title')} AS title FROM cat)""")
ORACLE["dedup_first"] = with_(CAT, PEOPLE, select=f"""
SELECT min(id) AS id, author, title_key FROM (
  SELECT c.id, a.name AS author, {KEY} AS title_key FROM cat c JOIN people a ON a.id = c.id AND a.pos = 0)
GROUP BY author, title_key""")
ORACLE["seeded_order"] = f"""
SELECT doc_id AS id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEL.seed}'), doc_id) AS place
FROM documents"""
ORACLE["candidates"] = with_(*ALL_CANDIDATES, select="SELECT * FROM candidates")
_STEPS = [("all", "true"), ("type and language", C_PROSE), ("class", C_CLASS), ("not translated", C_ROLE),
          ("no keyword", C_WORDS)]
ORACLE["filter_funnel"] = with_(*ALL_CANDIDATES, select=" UNION ALL ".join(
    [f"SELECT {i} AS ord, {q(step)} AS step, count(*) AS rows FROM cat WHERE "
     + " AND ".join(c for _, c in _STEPS[:i + 1]) for i, (step, _) in enumerate(_STEPS)]
    + ["SELECT 5, 'labelled', count(*) FROM labelled", "SELECT 6, 'first edition', count(*) FROM candidates"]))
ORACLE["epoch_distribution"] = with_(CAT, PEOPLE, LABELLED, select=" UNION ALL ".join(
    f"SELECT {i} AS ord, {q(e)} AS epoch, count(*) AS texts, count(DISTINCT author) AS authors FROM labelled "
    f"WHERE epoch = {q(e)}" for i, e in enumerate(EPOCHS.order)))

# Texts

# The marker lines, as in the text functions.
START = rf"(?i)\*{{3}}[{WS}]*START OF (?:THE|THIS) PROJECT GUTENBERG E-?BOOK[^\n]*"
END = rf"(?i)\*{{3}}[{WS}]*END OF (?:THE|THIS) PROJECT GUTENBERG E-?BOOK"
BODY = f"""marks AS (SELECT id, lang, raw,
  CASE WHEN regexp_matches(raw, {q(START)})
    THEN length(str_split_regex(raw, {q(START)})[1]) + length(regexp_extract(raw, {q(START)})) ELSE 0 END AS s,
  length(str_split_regex(raw, {q(END)})[1]) AS e FROM books),
body AS (SELECT id, lang, CASE WHEN e > s THEN substring(raw, s + 1, e - s) ELSE '' END AS body FROM marks)"""
PARS = f"""lines AS (SELECT id, lang, regexp_replace(regexp_replace(regexp_replace(
    replace(body, chr(13) || chr(10), chr(10)), {q(BRACKET_NOTE)}, ' ', 'g'),
    '(?m)^[{WS}*\\-.=_~]+$', '', 'g'), '[_=]', '', 'g') AS t FROM body),
pars AS (SELECT id, lang, i, p FROM (
  SELECT id, lang, generate_subscripts(ps, 1) AS i, unnest(ps) AS p FROM (
    SELECT id, lang, list_transform(str_split_regex(t, '\\n[{WS}]*\\n'), lambda x: {collapse_ws('x')}) AS ps
    FROM lines)) WHERE p <> ''),
clean AS (SELECT b.id, b.lang, coalesce(string_agg(p, chr(10) || chr(10) ORDER BY i), '') AS clean
  FROM body b LEFT JOIN pars USING (id) GROUP BY b.id, b.lang),
counts AS (SELECT id, CAST(len(regexp_extract_all(clean, {q(f'[^{WS}]+')})) AS BIGINT) AS n_words FROM clean)"""
_S = SETTINGS.sampling
SAMPLE = f"""sized AS (SELECT id, lang, i, str_split(p, ' ') AS ws, len(str_split(p, ' ')) AS n FROM pars),
before AS (SELECT *, sum(n) OVER (PARTITION BY id) AS total,
  coalesce(sum(n) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM sized),
kept AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had, sum(n) OVER (PARTITION BY id) AS rest
  FROM before WHERE b >= floor(CAST(total AS DOUBLE) * CAST({_S.skip_fraction} AS DOUBLE))),
parts AS (SELECT id, lang, i, array_to_string(list_slice(ws, 1, CAST(least(n, {_S.sample_words} - had) AS BIGINT)), ' ') AS p
  FROM kept WHERE rest >= {_S.sample_words} AND had < {_S.sample_words}),
samples AS (SELECT id, lang, string_agg(p, chr(10) || chr(10) ORDER BY i) AS sample FROM parts GROUP BY id, lang)"""
ORACLE["text_scan"] = with_(BOOKS, select="""
SELECT id, replace(replace(raw, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS raw FROM books""")
ORACLE["strip_boilerplate"] = with_(BOOKS, BODY, select="SELECT id, body FROM body")
ORACLE["clean_text"] = with_(BOOKS, BODY, PARS, select="SELECT id, clean FROM clean")
ORACLE["clean_words"] = with_(BOOKS, BODY, PARS, select="SELECT id, n_words FROM counts")
ORACLE["raw_words"] = f"SELECT doc_id, CAST(len(regexp_extract_all(text, {q(f'[^{WS}]+')})) AS BIGINT) AS n_words FROM documents"
ORACLE["min_length"] = with_(BOOKS, BODY, PARS, select=f"SELECT id, n_words FROM counts WHERE n_words >= {SEL.min_words}")
ORACLE["extract_sample"] = with_(BOOKS, BODY, PARS, SAMPLE, select="SELECT id, sample FROM samples")
ORACLE["sample_paragraphs"] = with_(BOOKS, BODY, PARS, SAMPLE, select="""
SELECT id AS doc_id, CAST(row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS INTEGER) AS part, p AS text FROM parts""")
ORACLE["quota_select"] = with_(*ALL_CANDIDATES, BOOKS, BODY, PARS, f"""
eligible AS (SELECT c.*, n_words FROM candidates c JOIN counts USING (id) WHERE n_words >= {SEL.min_words}),
few AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY shuffle_key, id) AS ra FROM eligible),
fewer AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY shuffle_key, id) AS re FROM few
  WHERE ra <= {SEL.max_per_author})""", select=f"SELECT * EXCLUDE (ra, re) FROM fewer WHERE re <= {SEL.max_per_epoch}")
# The walk itself, one row per step, with the counts as maps.
ORACLE["quota_select_general"] = f"""
WITH RECURSIVE input AS (SELECT o_orderkey AS id, o_custkey % 97 AS author, o_orderpriority AS epoch,
    md5(CAST(o_orderkey AS VARCHAR) || ':{SEL.seed}') AS shuffle_key FROM orders),
trimmed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY author, epoch ORDER BY shuffle_key, id) AS r
  FROM input) WHERE r <= 5),
placed AS (SELECT id, CAST(author AS BIGINT) AS author, epoch, shuffle_key,
  row_number() OVER (ORDER BY shuffle_key, id) AS k FROM trimmed),
walk AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS authors, CAST([] AS VARCHAR[]) AS epochs, false AS taken
  UNION ALL
  SELECT k, CASE WHEN ok THEN list_append(authors, author) ELSE authors END,
    CASE WHEN ok THEN list_append(epochs, epoch) ELSE epochs END, ok
  FROM (SELECT p.k, w.authors, w.epochs, p.author, p.epoch,
      len(list_filter(w.authors, lambda a: a = p.author)) < 5
      AND len(list_filter(w.epochs, lambda e: e = p.epoch)) < 90 AS ok
    FROM walk w JOIN placed p ON p.k = w.k + 1))
SELECT id, author, epoch, shuffle_key FROM placed JOIN walk USING (k) WHERE taken"""

# Tokens and style

LEX = "lex AS (SELECT * FROM (VALUES " + ", ".join(
    f"({q(lang)}, {q(word)}, {q(tag)})" for lang, word, tag in lexicon(STYLE.pos)) + ") AS v(lang, lower, upos))"


def token_ctes(source: str, doc: str, text: str) -> str:
    """Words and sentences of a text column as rows."""
    dots = text
    for _ in range(2):
        dots = f"regexp_replace({dots}, {q(INNER_DOT)}, '\\1\\2{NO_END}', 'g')"
    ends = f"regexp_replace({dots}, {q(BLANK_LINE)}, {q(SENTENCE_BREAK)}, 'g')"
    return f"""sents AS (SELECT d, lang, si, s FROM (
  SELECT {doc} AS d, lang, unnest(ss) AS s, generate_subscripts(ss, 1) AS si FROM (
    SELECT {doc}, lang, str_split_regex(regexp_replace({ends}, {q(SENTENCE_END)}, {q(SENTENCE_BREAK)}, 'g'),
      {q(SENTENCE_BREAK + '+')}) AS ss
    FROM {source})) WHERE regexp_matches(s, {q(WORD)})),
numbered AS (SELECT d, lang, s, si, row_number() OVER (PARTITION BY d ORDER BY si) - 1 AS sent_id FROM sents),
words AS (SELECT d, lang, sent_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS wi FROM (
  SELECT d, lang, sent_id, regexp_extract_all(s, {q(WORD)}) AS ws FROM numbered)),
tokens AS (SELECT d, lang, CAST(sent_id AS INTEGER) AS sent_id, token, lower(token) AS lower,
  row_number() OVER (PARTITION BY d ORDER BY sent_id, wi) - 1 AS pos FROM words)"""


DOC_TOKENS = token_ctes("documents", "doc_id", "text")
LENGTHS = "lengths AS (SELECT d, sent_id, count(*) AS words FROM tokens GROUP BY d, sent_id)"
WINDOWS = f"""wins AS (SELECT d, CAST(floor(pos / {STYLE.window}) AS BIGINT) AS win, count(DISTINCT lower) AS types,
  count(*) AS size FROM tokens GROUP BY 1, 2)"""
STTR = f"""ttr AS (SELECT d, avg(CASE WHEN size = {STYLE.window} THEN types / CAST({STYLE.window} AS DOUBLE) END) AS sttr
  FROM wins GROUP BY d)"""
RATIO = """ratio AS (SELECT d, count(*) AS n_words, avg(CASE WHEN upos IS NULL THEN 0.0 ELSE 1.0 END) AS function_word_ratio
  FROM tokens t LEFT JOIN lex l ON l.lang = t.lang AND l.lower = t.lower GROUP BY d)"""
MEDIAN = "medians AS (SELECT d, CAST(median(words) AS DOUBLE) AS median_sentence_length FROM lengths GROUP BY d)"
ORACLE["tokens"] = with_(LEX, DOC_TOKENS, select="""
SELECT d AS doc_id, pos, sent_id, token, upos FROM tokens t LEFT JOIN lex l ON l.lang = t.lang AND l.lower = t.lower""")
ORACLE["sentence_lengths"] = with_(DOC_TOKENS, LENGTHS, select="SELECT d AS doc_id, sent_id, words FROM lengths")
ORACLE["median_sentence_length"] = with_(DOC_TOKENS, LENGTHS, MEDIAN, select="""
SELECT doc_id, coalesce(n, 0) AS n_words, median_sentence_length FROM documents LEFT JOIN medians ON d = doc_id
LEFT JOIN (SELECT d, CAST(sum(words) AS BIGINT) AS n FROM lengths GROUP BY d) s ON s.d = doc_id""")
ORACLE["sttr"] = with_(DOC_TOKENS, WINDOWS, STTR, select="""
SELECT doc_id, round(sttr, 9) AS sttr FROM documents LEFT JOIN ttr ON d = doc_id""")
ORACLE["function_word_ratio"] = with_(LEX, DOC_TOKENS, RATIO, select="""
SELECT doc_id, round(function_word_ratio, 9) AS function_word_ratio FROM documents LEFT JOIN ratio ON d = doc_id""")
ORACLE["token_median_sentence_length"] = with_(DOC_TOKENS, LENGTHS, MEDIAN, select="""
SELECT d AS doc_id, median_sentence_length FROM medians""")
ORACLE["token_sttr"] = with_(DOC_TOKENS, WINDOWS, STTR, select="SELECT d AS doc_id, round(sttr, 9) AS sttr FROM ttr")
ORACLE["token_function_word_ratio"] = with_(LEX, DOC_TOKENS, RATIO, select="""
SELECT d AS doc_id, n_words, round(function_word_ratio, 9) AS function_word_ratio FROM ratio""")
ORACLE["token_windows"] = with_(DOC_TOKENS, WINDOWS, select="SELECT d AS doc_id, win, types, size FROM wins")

NAMES = "names AS (SELECT DISTINCT lower(name) AS key FROM (" + " UNION ALL ".join(
    f"SELECT unnest(regexp_extract_all(text, {q(p)})) AS name FROM benchmark" for p in NAME_PATTERNS) + "))"


def gazetteer(source: str, doc: str, text: str, out: str = "found") -> str:
    """Listed names by neighbouring word rows."""
    return f"""gw AS (SELECT {doc} AS d, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM (
  SELECT {doc}, regexp_extract_all({text}, {q(WORD)}) AS ws FROM {source})),
next AS (SELECT d, pos, w, {', '.join(f'lead(w, {i}) OVER (PARTITION BY d ORDER BY pos) AS w{i}' for i in range(1, 5))}
  FROM gw),
grams AS (SELECT d, pos, 0 AS extra, w AS text FROM next
  {' '.join(f"UNION ALL SELECT d, pos, {k}, concat_ws(' ', w, {', '.join(f'w{i}' for i in range(1, k + 1))}) FROM next "
            f"WHERE w{k} IS NOT NULL" for k in range(1, 5))}),
hits AS (SELECT d, pos, max(extra) AS extra, max_by(text, extra) AS text FROM grams
  WHERE lower(text) IN (SELECT key FROM names) GROUP BY d, pos),
{out} AS (SELECT d, pos, text AS name FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o
  WHERE o.d = h.d AND o.pos < h.pos AND o.pos + o.extra >= h.pos))"""


ORACLE["gazetteer_mentions"] = with_(NAMES, gazetteer("documents", "doc_id", "text"), select="""
SELECT d AS doc_id, pos, name FROM found""")
ORACLE["cue_mentions"] = f"""
SELECT doc_id, name, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, {q(cue_pattern(PERSON_TITLES))}, 1)) AS name
  FROM ({derived.CUED.format(documents=DOCS)})) GROUP BY doc_id, name"""


def person_ctes(source: str) -> str:
    """Normalised names ``normal(doc_id, pos, name)``, counted and merged."""
    titles = ", ".join(q(t) for t in STYLE.titles)
    return f"""parts AS (SELECT doc_id, pos, generate_subscripts(ps, 1) AS i, trim(unnest(ps), {q(NAME_EDGE)}) AS p FROM (
  SELECT doc_id, pos, str_split_regex(lower(name), '[{WS}]+') AS ps FROM {source})),
normal AS (SELECT doc_id, pos, coalesce(string_agg(p, ' ' ORDER BY i) FILTER (p <> '' AND p NOT IN ({titles})), '') AS name
  FROM parts GROUP BY doc_id, pos),
named AS (SELECT doc_id, name, count(*) AS mentions FROM normal GROUP BY doc_id, name),
merged AS (SELECT doc_id, name, CAST(sum(mentions) AS BIGINT) AS mentions FROM (
  SELECT n.doc_id, n.mentions, CASE WHEN right(n.name, 1) = 's' AND EXISTS (SELECT 1 FROM named b
      WHERE b.doc_id = n.doc_id AND b.name = left(n.name, length(n.name) - 1)) THEN left(n.name, length(n.name) - 1)
    WHEN n.name <> '' THEN n.name END AS name FROM named n) WHERE name IS NOT NULL GROUP BY doc_id, name),
owners AS (SELECT doc_id, name, str_split(name, ' ') AS ws FROM merged WHERE position(' ' IN name) > 0),
groups AS (SELECT doc_id, character, CAST(sum(mentions) AS BIGINT) AS mentions FROM (
  SELECT m.doc_id, m.mentions, CASE WHEN position(' ' IN m.name) > 0 THEN str_split(m.name, ' ')[-1]
    ELSE coalesce((SELECT str_split(min(o.name), ' ')[-1] FROM owners o
      WHERE o.doc_id = m.doc_id AND list_contains(o.ws, m.name)), m.name) END AS character FROM merged m)
  GROUP BY doc_id, character),
cast_size AS (SELECT doc_id, count(*) AS characters FROM groups WHERE mentions >= {STYLE.min_mentions} GROUP BY doc_id)"""


MENTIONS = "mentions AS (SELECT d AS doc_id, pos, name FROM found)"
PERSONS = (NAMES, gazetteer("documents", "doc_id", "text"), MENTIONS, person_ctes("mentions"))
ORACLE["person_names"] = with_(*PERSONS, select="SELECT doc_id, pos, name FROM normal")
ORACLE["mention_counts"] = with_(*PERSONS, select="SELECT * FROM named")
ORACLE["merge_genitives"] = with_(*PERSONS, select="SELECT * FROM merged")
ORACLE["character_groups"] = with_(*PERSONS, select="SELECT * FROM groups")
ORACLE["character_counts"] = with_(*PERSONS, select="SELECT * FROM cast_size")
INFLECTED = (*PERSONS[:3], """inflected AS (SELECT doc_id, pos, CASE WHEN pos % 3 = 0 THEN name || 's' ELSE name END AS name
  FROM mentions)""", person_ctes("inflected"))
ORACLE["inflected_genitives"] = with_(*INFLECTED, select="SELECT * FROM merged")
ORACLE["inflected_groups"] = with_(*INFLECTED, select="SELECT * FROM groups")
ORACLE["character_density"] = with_(*PERSONS, select=f"""
SELECT doc_id, round(CASE WHEN n > 0 THEN coalesce(characters, 0) / CAST(n AS DOUBLE) * 1000 END, 6) AS character_density
FROM (SELECT doc_id, len(regexp_extract_all(text, {q(WORD)})) AS n FROM documents) LEFT JOIN cast_size USING (doc_id)""")
ORACLE["token_features"] = with_(
    LEX, DOC_TOKENS, LENGTHS, MEDIAN, WINDOWS, STTR, RATIO, *PERSONS, select="""
SELECT m.d AS doc_id, round(median_sentence_length, 9) AS median_sentence_length, round(sttr, 9) AS sttr,
  round(function_word_ratio, 9) AS function_word_ratio,
  round(coalesce(characters, 0) / CAST(n_words AS DOUBLE) * 1000, 9) AS character_density
FROM medians m JOIN ttr t ON t.d = m.d JOIN ratio r ON r.d = m.d LEFT JOIN cast_size c ON c.doc_id = m.d""")
FEATURE_CTES = (BOOKS, BODY, PARS.replace("parts AS", "parts0 AS"), SAMPLE.replace("parts", "cut"), LEX,
                token_ctes("samples", "id", "sample"), LENGTHS, MEDIAN, WINDOWS, STTR, RATIO, NAMES,
                gazetteer("samples", "id", "sample"),
                "listed AS (SELECT d AS doc_id, pos, name FROM found)", person_ctes("listed"))
FEATURE_COLS = """round(median_sentence_length, 9) AS median_sentence_length, round(sttr, 9) AS sttr,
  round(function_word_ratio, 9) AS function_word_ratio,
  round(coalesce(characters, 0) / CAST(n_words AS DOUBLE) * 1000, 9) AS character_density"""
FEATURE_JOIN = """samples s LEFT JOIN medians m ON m.d = s.id LEFT JOIN ttr t ON t.d = s.id
LEFT JOIN ratio r ON r.d = s.id LEFT JOIN cast_size c ON c.doc_id = s.id"""
ORACLE["feature_table"] = with_(*FEATURE_CTES, select=f"SELECT s.id, {FEATURE_COLS} FROM {FEATURE_JOIN}")
ORACLE["streamed_features"] = ORACLE["feature_table"]
ORACLE["incremental_features"] = with_(CAT, PEOPLE, *FEATURE_CTES, select=f"""
SELECT s.id, p.name AS author, {collapse_ws('c0.title')} AS title, p.birth_year, p.death_year, {EPOCH} AS epoch,
  {FEATURE_COLS} FROM {FEATURE_JOIN} JOIN people p ON p.id = s.id AND p.pos = 0 JOIN cat c0 ON c0.id = s.id""")
_CHAIN = CHAIN.selection
CHAIN_CTES = (*ALL_CANDIDATES, *FEATURE_CTES, f"""
eligible AS (SELECT c.*, n_words FROM candidates c JOIN counts USING (id) WHERE n_words >= {_CHAIN.min_words}),
few AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY shuffle_key, id) AS ra FROM eligible),
fewer AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY shuffle_key, id) AS re FROM few
  WHERE ra <= {_CHAIN.max_per_author}),
chain AS (SELECT s.id, f.author, f.title, f.birth_year, f.death_year, f.epoch, {FEATURE_COLS.replace("round(", "(").replace(", 9)", ")").replace("n_words", "r.n_words")}
  FROM {FEATURE_JOIN} JOIN fewer f ON f.id = s.id AND re <= {_CHAIN.max_per_epoch})""")
ORACLE["pipeline_features"] = with_(*CHAIN_CTES, select="SELECT id, author, title, birth_year, death_year, epoch, "
                                    + ", ".join(f"round({c}, 9) AS {c}" for c in FEATURE_COLUMNS) + " FROM chain")
ORACLE["new_ids"] = "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels"

# Group statistics

FIN = f"fin AS ({derived.FEATURES_DUCKDB})"


def long(source: str, by: str, columns) -> str:
    return "long AS (" + " UNION ALL ".join(
        f"SELECT {q(c)} AS feature, {by} AS grp, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns) + ")"


F_LONG, L_LONG = long("fin", "epoch", FEATURES), long("lineitem", "l_returnflag", MEASURES)


def moments(digits: int) -> str:
    return (f"count(*) AS n, round(avg(value), {digits}) AS mean, round(stddev_samp(value), {digits}) AS sd, "
            f"round(median(value), {digits}) AS median")


ORACLE["rounded_csv"] = with_(FIN, select="SELECT id, author, epoch, " + ", ".join(
    f"round_even({c}, 4) + 0.0 AS {c}" for c in FEATURES) + " FROM fin")
ORACLE["summary_by_group"] = with_(FIN, F_LONG, select=f"""
SELECT grp, feature, coalesce(n, 0) AS n, mean, sd, median FROM
  (SELECT unnest({CLASSES + ['E9']}) AS grp) CROSS JOIN (SELECT unnest({FEATURES}) AS feature)
  LEFT JOIN (SELECT grp, feature, {moments(6)} FROM long GROUP BY grp, feature) USING (grp, feature)""")
ORACLE["summary_lineitem"] = with_(L_LONG, select=f"SELECT grp, feature, {moments(4)} FROM long GROUP BY grp, feature")
RANKS = """ranked AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value)
    + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r,
  count(*) OVER (PARTITION BY feature, value) AS t FROM long)"""


# Of three classes the tail is that of two degrees of freedom; of any number it comes from the series of the lower part.
TWO_DEGREES = "exp(-h / 2)"
ANY_DEGREES = """1 - list_sum(list_transform(range(CAST(h + 400 AS BIGINT)), lambda i:
  exp(((classes - 1) / 2 + i) * ln(h / 2) - h / 2 - lgamma((classes - 1) / 2 + i + 1))))"""


def kruskal(digits: int, tail: str = TWO_DEGREES) -> str:
    return f"""SELECT feature, CAST(n AS BIGINT) AS n, round(h, {digits}) AS h, round({tail}, {digits}) AS p_value FROM (
  SELECT feature, n, classes, (12 / (n * (n + 1)) * sq - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h FROM (
    SELECT feature, CAST(count(*) AS DOUBLE) AS classes, CAST(sum(c) AS DOUBLE) AS n, sum(rs * rs / c) AS sq, sum(tt) AS ties FROM (
      SELECT feature, grp, CAST(count(*) AS DOUBLE) AS c, CAST(sum(r) AS DOUBLE) AS rs, sum(CAST(t AS DOUBLE) * t - 1) AS tt
      FROM ranked GROUP BY feature, grp) GROUP BY feature))"""


ORACLE["kruskal"] = with_(FIN, F_LONG, RANKS, select=kruskal(6))
ORACLE["kruskal_lineitem"] = with_(L_LONG, RANKS, select=kruskal(5))
ORACLE["kruskal_parts"] = with_(long("lineitem", "l_suppkey", MEASURES), RANKS, select=kruskal(4, ANY_DEGREES))
ORACLE["average_ranks"] = with_(L_LONG, RANKS, select="""
SELECT feature, grp, value, count(*) AS n, CAST(max(r) AS DOUBLE) AS mid_rank FROM ranked GROUP BY feature, grp, value""")


def boxes(digits: int) -> str:
    names = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return f"""SELECT grp, feature, {', '.join(f'round({n}, {digits}) AS {n}' for n in names)} FROM (
  SELECT b.grp, b.feature, q1, median, q3, least(q1, min(value) FILTER (value >= q1 - 1.5 * (q3 - q1))) AS whisker_low,
    greatest(q3, max(value) FILTER (value <= q3 + 1.5 * (q3 - q1))) AS whisker_high
  FROM (SELECT grp, feature, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3
    FROM long GROUP BY grp, feature) b JOIN long USING (grp, feature) GROUP BY b.grp, b.feature, q1, median, q3)"""


ORACLE["box_stats"] = with_(FIN, F_LONG, select=boxes(6))
ORACLE["box_stats_lineitem"] = with_(L_LONG, select=boxes(4))
ORACLE["reindexed_counts"] = """
SELECT CAST(ord AS INTEGER) AS ord, d.p AS o_orderpriority, count(o_orderkey) AS n FROM (VALUES (0, '1-URGENT'), (1, '2-HIGH'),
  (2, '3-MEDIUM'), (3, '4-NOT SPECIFIED'), (4, '5-LOW'), (5, '6-NONE')) AS d(ord, p)
LEFT JOIN orders ON o_orderpriority = d.p GROUP BY ord, d.p"""

# Folds and cheap models


def group_folds(source: str, out: str, folds: int, group: str = "author", label: str = "epoch") -> str:
    return f"""{out}_n AS (SELECT {group} AS g, {label} AS c, count(*) AS n FROM {source} GROUP BY 1, 2),
{out}_c AS (SELECT g, c, sum(n) OVER (PARTITION BY g) AS total,
  row_number() OVER (PARTITION BY g ORDER BY n DESC, c) AS k FROM {out}_n),
{out}_r AS (SELECT g, row_number() OVER (PARTITION BY c ORDER BY total DESC, md5(CAST(g AS VARCHAR) || ':{EV.seed}'), g) - 1 AS r
  FROM {out}_c WHERE k = 1),
{out} AS (SELECT g, CAST(CASE WHEN (r // {folds}) % 2 = 0 THEN r % {folds} ELSE {folds} - 1 - r % {folds} END AS INTEGER) AS fold
  FROM {out}_r)"""


def random_folds(source: str, folds: int) -> str:
    return f"""SELECT *, CAST((row_number() OVER (PARTITION BY epoch
  ORDER BY md5(CAST(id AS VARCHAR) || ':{EV.seed}'), id) - 1) % {folds} AS INTEGER) AS fold FROM {source}"""


SPLIT = (FIN, group_folds("fin", "gf", EV.test_folds),
         "train AS (SELECT fin.* FROM fin JOIN gf ON g = author WHERE fold <> 0)",
         "test AS (SELECT fin.* FROM fin JOIN gf ON g = author WHERE fold = 0)")


def dims(source: str, cols: str, columns=FEATURES) -> str:
    """Long form with one row per dimension."""
    return " UNION ALL ".join(f"SELECT {cols}, {i + 1} AS dim, {c} AS x FROM {source}" for i, c in enumerate(columns))


MODEL = (f"tl AS ({dims('train', 'id, epoch')})",
         """scales AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale
  FROM tl GROUP BY dim)""",
         """centroids AS (SELECT epoch AS label, dim, count(*) AS n, avg((x - mean) / scale) AS centroid
  FROM tl JOIN scales USING (dim) GROUP BY 1, 2)""",
         f"el AS ({dims('test', 'id, epoch')})",
         """dist AS (SELECT id, epoch, label, sqrt(sum(((x - mean) / scale - centroid) ** 2)) AS dist
  FROM el JOIN scales USING (dim) JOIN centroids USING (dim) GROUP BY id, epoch, label)""",
         """near AS (SELECT id, epoch, label AS pred FROM (SELECT *,
  row_number() OVER (PARTITION BY id ORDER BY dist, label) AS k FROM dist) WHERE k = 1)""",
         "top AS (SELECT epoch AS pred FROM train GROUP BY epoch ORDER BY count(*) DESC, epoch LIMIT 1)",
         f"""preds AS (SELECT id, epoch AS truth, pred, {q(CENTROID)} AS model FROM near
  UNION ALL SELECT id, epoch, pred, {q(BASELINE)} FROM test CROSS JOIN top)""")


def macro(source: str, keys: str, out: str) -> str:
    """Accuracy and macro-F1 by predicate counts per label."""
    k = keys + ", " if keys else ""
    on = " AND ".join(f"p.{c.strip()} = l.{c.strip()}" for c in keys.split(",")) if keys else "true"
    return f"""{out}_l AS (SELECT DISTINCT {k}truth AS label FROM {source} UNION SELECT DISTINCT {k}pred FROM {source}),
{out} AS (SELECT {k}max(acc) AS accuracy, avg(f1) AS macro_f1 FROM (
  SELECT {', '.join('l.' + c.strip() for c in keys.split(','))  + ', ' if keys else ''}l.label,
    avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END) AS acc,
    2.0 * count(*) FILTER (truth = l.label AND pred = l.label)
      / (count(*) FILTER (truth = l.label) + count(*) FILTER (pred = l.label)) AS f1
  FROM {out}_l l JOIN {source} p ON {on} GROUP BY {', '.join('l.' + c.strip() for c in keys.split(',')) + ', ' if keys else ''}l.label)
  {'GROUP BY ' + keys if keys else ''})"""


ORACLE["group_folds"] = with_(FIN, group_folds("fin", "gf", 5), select="SELECT g AS author, fold FROM gf")
ORACLE["group_folds_orders"] = with_(group_folds("orders", "gf", 5, "o_custkey", "o_orderpriority"),
                                     select="SELECT g AS o_custkey, fold FROM gf")
ORACLE["random_folds"] = with_(FIN, select=f"SELECT id, epoch, fold FROM ({random_folds('fin', 5)})")
ORACLE["leak_check"] = with_(*SPLIT, select="SELECT author FROM train INTERSECT SELECT author FROM test")
ORACLE["leaky_authors"] = with_(FIN, f"rf AS ({random_folds('fin', 5)})", select="""
SELECT author FROM rf WHERE fold <> 0 INTERSECT SELECT author FROM rf WHERE fold = 0""")
ORACLE["leak_error"] = f"SELECT count(*) AS shared, true AS refused FROM ({ORACLE['leaky_authors']})"
ORACLE["split_sizes"] = with_(*SPLIT, select=" UNION ALL ".join(
    f"SELECT '{part}' AS part, count(*) AS texts, count(DISTINCT author) AS authors FROM {src}"
    for part, src in (("all", "fin"), ("train", "train"), ("test", "test"))))
ORACLE["majority"] = with_(*SPLIT, *MODEL, select="SELECT pred FROM top")
ORACLE["centroid_fit"] = with_(*SPLIT, *MODEL, select="""
SELECT label, dim, n, round(mean, 6) AS mean, round(scale, 6) AS scale, round(centroid, 6) AS centroid
FROM centroids JOIN scales USING (dim)""")
ORACLE["standardised"] = with_(*SPLIT, *MODEL, select="SELECT id, " + ", ".join(
    f"max(round((x - mean) / scale, 6)) FILTER (dim = {i + 1}) AS z{i + 1}" for i in range(4))
    + " FROM el JOIN scales USING (dim) GROUP BY id")
NULLS = """marked AS (SELECT doc_id AS id, CAST(max(quality) AS VARCHAR) AS label FROM labels GROUP BY doc_id),
nrows AS (SELECT d.doc_id AS id, label, CASE WHEN d.doc_id % 7 <> 0 THEN source END AS author
  FROM documents d LEFT JOIN marked m ON m.id = d.doc_id)"""
ORACLE["random_folds_nulls"] = with_(NULLS, select=f"""
SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR) || ':{EV.seed}'), id) - 1) % 5
  AS INTEGER) AS fold FROM nrows""")
ORACLE["group_folds_nulls"] = with_(NULLS, f"""
per AS (SELECT author, label, count(*) AS n FROM nrows GROUP BY ALL),
cls AS (SELECT author, label, sum(n) OVER (PARTITION BY author) AS total,
  row_number() OVER (PARTITION BY author ORDER BY n DESC, label NULLS FIRST) AS k FROM per),
pl AS (SELECT author, row_number() OVER (PARTITION BY label ORDER BY total DESC,
  md5(coalesce(author, '') || ':{EV.seed}'), author NULLS FIRST) - 1 AS r FROM cls WHERE k = 1)""", select="""
SELECT id, n.author, CAST(CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS INTEGER) AS fold
FROM nrows n JOIN pl ON pl.author IS NOT DISTINCT FROM n.author""")
ORACLE["centroid_nulls"] = with_(FIN, f"""
holey AS (SELECT id, epoch, CASE WHEN id % 5 <> 0 THEN f1 END AS f1, f2, f3, f4 FROM fin),
el AS ({dims('holey', 'id, epoch')}),
sc AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale
  FROM el WHERE id % 3 <> 0 GROUP BY dim),
ce AS (SELECT epoch AS label, dim, avg((x - mean) / scale) AS c FROM el JOIN sc USING (dim) WHERE id % 3 <> 0 GROUP BY 1, 2),
di AS (SELECT id, label, sqrt(sum(((x - mean) / scale - c) ** 2)) AS d FROM el JOIN sc USING (dim) JOIN ce USING (dim)
  WHERE id % 5 <> 0 GROUP BY 1, 2)""", select="""
SELECT s.id, s.epoch, n.pred FROM holey s LEFT JOIN (SELECT id, label AS pred FROM (SELECT *,
  row_number() OVER (PARTITION BY id ORDER BY d, label) AS k FROM di) WHERE k = 1) n USING (id)""")
PARTS = f"""el AS ({dims('lineitem', 'l_partkey AS label', MEASURES)}),
sc AS (SELECT dim, avg(x) AS mean, stddev_pop(x) AS scale FROM el GROUP BY dim),
ce AS (SELECT label, dim, count(*) AS n, any_value(mean) AS mean, any_value(scale) AS scale, avg((x - mean) / scale) AS centroid
  FROM el JOIN sc USING (dim) GROUP BY label, dim)"""
ORACLE["centroid_many_fit"] = with_(PARTS, select="""
SELECT label, dim, n, round(mean, 6) AS mean, round(scale, 6) AS scale, round(centroid, 6) + 0.0 AS centroid FROM ce""")
_MEAN_LINE = ", ".join(f"avg({c}) AS {c}" for c in MEASURES)
_WIDE = ", ".join(f"max({{0}}) FILTER (dim = {i + 1}) AS x{i}" for i in range(len(MEASURES)))
ORACLE["centroid_many"] = with_(PARTS, f"""ol AS (SELECT o_custkey, {_MEAN_LINE} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
ow AS (SELECT o_custkey, {_WIDE.format("(x - mean) / scale")} FROM ({dims('ol', 'o_custkey', MEASURES)}) JOIN sc USING (dim) GROUP BY 1),
cw AS (SELECT label, {_WIDE.format("centroid")} FROM ce GROUP BY 1)""", select="""
SELECT o_custkey, arg_min(label, (sqrt((ow.x0 - cw.x0) ** 2 + (ow.x1 - cw.x1) ** 2 + (ow.x2 - cw.x2) ** 2), label)) AS pred
FROM ow CROSS JOIN cw GROUP BY o_custkey""")
ORACLE["logistic_gradient"] = f"""
SELECT label, feature, CAST(0 AS DOUBLE) AS slope FROM (SELECT unnest({CLASSES}) AS label)
CROSS JOIN (SELECT unnest({FEATURES}) AS feature)"""
ORACLE["saved_predictions"] = with_(*SPLIT, select="SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM test")
ORACLE["forest_layouts"] = ORACLE["saved_predictions"]
ORACLE["required_columns"] = "SELECT count(*) AS rows, 'missing columns: title, locc' AS said FROM documents"
ORACLE["centroid_distances"] = with_(*SPLIT, *MODEL, select="SELECT id, label, round(dist, 6) AS dist FROM dist")
ORACLE["centroid_predict"] = with_(*SPLIT, *MODEL, select="SELECT id, epoch, pred FROM near")
ORACLE["centroid_predict_wide"] = """
WITH el AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
scales AS (SELECT dim, avg(x) AS mean, stddev_pop(x) AS scale FROM el GROUP BY dim),
z AS (SELECT vec_id, label, dim, (x - mean) / CASE WHEN scale = 0 THEN 1 ELSE scale END AS z FROM el JOIN scales USING (dim)),
centroids AS (SELECT label AS pred, dim, avg(z) AS c FROM z GROUP BY 1, 2),
dist AS (SELECT vec_id, label, pred, sqrt(sum((z - c) ** 2)) AS dist FROM z JOIN centroids USING (dim) GROUP BY 1, 2, 3)
SELECT vec_id, label, pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, pred) AS k FROM dist) WHERE k = 1"""
SCORES = macro("preds", "model", "sc")
ORACLE["test_scores"] = with_(*SPLIT, *MODEL, SCORES, select="""
SELECT model, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM sc""")
ORACLE["pipeline_analysis"] = with_(*CHAIN_CTES, "fin AS (SELECT id, author, epoch, " + ", ".join(
    f"{c} AS {f}" for c, f in zip(FEATURE_COLUMNS, FEATURES)) + " FROM chain)", *SPLIT[1:], *MODEL, SCORES, select="""
SELECT model, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM sc""")
REPORT = f"""labels_ AS (SELECT CAST(o AS INTEGER) AS ord, label FROM (VALUES {', '.join(f"({i}, {q(c)})" for i, c in enumerate(CLASSES))}) AS v(o, label)),
per AS (SELECT model, ord, label, count(*) FILTER (truth = label AND pred = label) AS hits,
  count(*) FILTER (pred = label) AS predicted, count(*) FILTER (truth = label) AS support
  FROM preds CROSS JOIN labels_ GROUP BY model, ord, label),
rep AS (SELECT model, ord, label, CASE WHEN predicted = 0 THEN 0.0 ELSE hits / CAST(predicted AS DOUBLE) END AS precision,
  CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END AS recall,
  CASE WHEN predicted + support = 0 THEN 0.0 ELSE 2.0 * hits / (predicted + support) END AS f1, support, hits FROM per),
report AS (SELECT model, ord, label, precision, recall, f1, support FROM rep
  UNION ALL SELECT model, 3, 'accuracy', NULL, NULL, sum(hits) / CAST(sum(support) AS DOUBLE), CAST(sum(support) AS BIGINT) FROM rep GROUP BY model
  UNION ALL SELECT model, 4, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM rep GROUP BY model
  UNION ALL SELECT model, 5, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM rep GROUP BY model)"""
ORACLE["class_report"] = with_(*SPLIT, *MODEL, REPORT, select="""
SELECT model, ord, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""")
ORACLE["confusion"] = with_(*SPLIT, *MODEL, REPORT, select="""
SELECT model, t_ord, truth, p_ord, pred, n, round(CASE WHEN total = 0 THEN 0.0 ELSE n / CAST(total AS DOUBLE) END, 6) AS share
FROM (SELECT *, sum(n) OVER (PARTITION BY model, truth) AS total FROM (
  SELECT m.model, t.ord AS t_ord, t.label AS truth, p.ord AS p_ord, p.label AS pred, count(x.id) AS n
  FROM (SELECT DISTINCT model FROM preds) m CROSS JOIN labels_ t CROSS JOIN labels_ p
  LEFT JOIN preds x ON x.model = m.model AND x.truth = t.label AND x.pred = p.label GROUP BY ALL))""")
_BASE, _NEAR = pred_column(BASELINE), pred_column(CENTROID)
ORACLE["prediction_columns"] = with_(*SPLIT, *MODEL, select=f"""
SELECT t.id, t.author, t.epoch, top.pred AS {_BASE}, n.pred AS {_NEAR} FROM test t JOIN near n USING (id) CROSS JOIN top""")
ORACLE["misclassified"] = with_(*SPLIT, *MODEL, select=f"""
SELECT t.id, t.author, t.epoch, n.pred AS {_NEAR} FROM test t JOIN near n USING (id) WHERE t.epoch IS DISTINCT FROM n.pred""")


def cv(name: str, split: str, folds_cte: str) -> tuple[str, ...]:
    """Cross-validation with the training rows repeated for every fold."""
    n = name
    return (folds_cte, f"""{n}_t AS (SELECT f.fold, r.id, r.epoch, r.f1, r.f2, r.f3, r.f4 FROM {n}_rows r
  JOIN (SELECT DISTINCT fold FROM {n}_rows) f ON f.fold <> r.fold)""",
            f"{n}_tl AS ({dims(n + '_t', 'fold, id, epoch')})",
            f"""{n}_sc AS (SELECT fold, dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale
  FROM {n}_tl GROUP BY fold, dim)""",
            f"""{n}_ce AS (SELECT fold, epoch AS label, dim, avg((x - mean) / scale) AS c
  FROM {n}_tl JOIN {n}_sc USING (fold, dim) GROUP BY 1, 2, 3)""",
            f"{n}_el AS ({dims(n + '_rows', 'fold, id, epoch')})",
            f"""{n}_di AS (SELECT fold, id, epoch, label, sqrt(sum(((x - mean) / scale - c) ** 2)) AS d
  FROM {n}_el JOIN {n}_sc USING (fold, dim) JOIN {n}_ce USING (fold, dim) GROUP BY 1, 2, 3, 4)""",
            f"""{n}_top AS (SELECT fold, epoch AS pred FROM (SELECT fold, epoch,
  row_number() OVER (PARTITION BY fold ORDER BY count(*) DESC, epoch) AS k FROM {n}_t GROUP BY fold, epoch) WHERE k = 1)""",
            f"""{n}_p AS (SELECT {q(CENTROID)} AS model, fold, epoch AS truth, label AS pred FROM (SELECT *,
  row_number() OVER (PARTITION BY id ORDER BY d, label) AS k FROM {n}_di) WHERE k = 1
  UNION ALL SELECT {q(BASELINE)}, fold, epoch, pred FROM {n}_rows JOIN {n}_top USING (fold))""",
            macro(f"{n}_p", "model, fold", f"{n}_s"),
            f"""{n} AS (SELECT model, {q(split)} AS split, avg(accuracy) AS accuracy_mean, stddev_pop(accuracy) AS accuracy_sd,
  avg(macro_f1) AS macro_f1_mean, stddev_pop(macro_f1) AS macro_f1_sd FROM {n}_s GROUP BY model)""")


GROUPED_CV = cv("gcv", GROUPED, group_folds("train", "cf", EV.cv_folds)
                + ",\ngcv_rows AS (SELECT train.*, fold FROM train JOIN cf ON g = author)")
RANDOM_CV = cv("rcv", RANDOM, f"rcv_rows AS ({random_folds('train', EV.cv_folds)})")
ORACLE["cross_validation"] = with_(*SPLIT, *GROUPED_CV, *RANDOM_CV, select="""
SELECT model, split, round(accuracy_mean, 6) AS accuracy_mean, round(accuracy_sd, 6) AS accuracy_sd,
  round(macro_f1_mean, 6) AS macro_f1_mean, round(macro_f1_sd, 6) AS macro_f1_sd
FROM (SELECT * FROM gcv UNION ALL SELECT * FROM rcv)""")


def logistic(name: str, rows: str, scale: str, sets: dict[str, list[str]], steps: int = 300) -> tuple[str, ...]:
    """Regressions by plain gradient steps of a safe length, one per set of columns and fold of ``rows``.

    ``<name>_w`` are the weights after the last step, ``<name>_p`` the predictions of the rows held out.
    """
    n, k, p = name, len(CLASSES), len(FEATURES) + 1
    masks = ", ".join(f"({q(s)}, {', '.join(str(float(c in used)) for c in FEATURES)})" for s, used in sets.items())
    x = "[" + ", ".join(f"u{i} * ({c} - mean[{i + 1}]) / scale[{i + 1}]" for i, c in enumerate(FEATURES)) + ", 1.0]"
    logit = [f"CASE WHEN seen[{y + 1}] THEN " + " + ".join(f"w[{y * p + j + 1}] * x[{j + 1}]" for j in range(p))
             + " ELSE -1e300 END" for y in range(k)]
    chance = f"list_transform(l, lambda v: exp(v - list_max(l)) / list_sum(list_transform(l, lambda o: exp(o - list_max(l)))))"
    slope = [f"sum((c[{y + 1}] - CAST(epoch = {q(CLASSES[y])} AS INT)) * x[{j + 1}])" for y in range(k) for j in range(p)]
    step = [f"w[{i + 1}] - (g[{i + 1}] + {0.0 if i % p == p - 1 else 1.0} * w[{i + 1}]) / reach" for i in range(k * p)]
    return (f"""{n}_m AS (SELECT row_number() OVER (ORDER BY s, fold) AS m, * FROM (VALUES {masks}) AS v(s, {', '.join(f'u{i}' for i in range(p - 1))})
  CROSS JOIN (SELECT fold, list(mean ORDER BY dim) AS mean, list(scale ORDER BY dim) AS scale FROM {scale} GROUP BY fold))""",
            f"{n}_x AS (SELECT m, s, r.fold AS own, id, epoch, r.fold = d.fold AS held, {x} AS x FROM {rows} r CROSS JOIN {n}_m d)",
            f"""{n}_n AS (SELECT m, 1 + 0.5 * sum(list_sum(list_transform(x, lambda v: v * v))) AS reach,
  [{', '.join(f"count(*) FILTER (epoch = {q(c)}) > 0" for c in CLASSES)}] AS seen FROM {n}_x WHERE NOT held GROUP BY m)""",
            f"""{n}_s AS (SELECT m, 0 AS it, list_transform(range({k * p}), lambda i: CAST(0 AS DOUBLE)) AS w FROM {n}_m UNION ALL
  SELECT m, it + 1, [{', '.join(step)}] FROM (SELECT m, it, any_value(w) AS w, any_value(reach) AS reach, [{', '.join(slope)}] AS g FROM (
    SELECT m, it, w, reach, x, epoch, {chance} AS c FROM (SELECT t.m, it, w, reach, x, epoch, [{', '.join(logit)}] AS l
      FROM {n}_s t JOIN {n}_x x ON x.m = t.m AND NOT held JOIN {n}_n b ON b.m = t.m WHERE it < {steps})) GROUP BY m, it))""",
            f"{n}_w AS (SELECT {n}_s.*, seen FROM {n}_s JOIN {n}_n USING (m) WHERE it = {steps})",
            f"""{n}_p AS (SELECT s AS model, own AS fold, epoch AS truth, {CLASSES}[list_position(l, list_max(l))] AS pred FROM (
  SELECT s, own, epoch, [{', '.join(logit)}] AS l FROM {n}_x x JOIN {n}_w t ON t.m = x.m WHERE held))""")


SETS = {"all": FEATURES, **{"only:" + c: [c] for c in FEATURES}, **{"without:" + c: [o for o in FEATURES if o != c] for c in FEATURES}}
ORACLE["feature_ablation"] = "WITH RECURSIVE " + ",\n".join((
    *SPLIT, *GROUPED_CV[:4], *logistic("ab", "gcv_rows", "gcv_sc", SETS), macro("ab_p", "model, fold", "ab_f"),
    "ab_a AS (SELECT model, avg(macro_f1) AS f FROM ab_f GROUP BY model)")) + f"""
SELECT feature, round(o.f, 9) AS macro_f1_only_this, round(w.f, 9) AS macro_f1_without_this, round(a.f - w.f, 9) + 0.0 AS drop_when_removed
FROM (SELECT unnest({FEATURES}) AS feature) JOIN ab_a o ON o.model = 'only:' || feature JOIN ab_a w ON w.model = 'without:' || feature
JOIN ab_a a ON a.model = 'all'"""
_CV_COLUMNS = ("accuracy_mean", "accuracy_sd", "macro_f1_mean", "macro_f1_sd")


def learned_cv(name: str, split: str, rows: str, scale: str) -> tuple[str, ...]:
    return (*logistic(f"{name}l", rows, scale, {LOGISTIC: FEATURES}), macro(f"{name}l_p", "model, fold", f"{name}l_f"),
            f"""{name}l AS (SELECT model, {q(split)} AS split, avg(accuracy) AS accuracy_mean, stddev_pop(accuracy) AS accuracy_sd,
  avg(macro_f1) AS macro_f1_mean, stddev_pop(macro_f1) AS macro_f1_sd FROM {name}l_f GROUP BY model)""")


LEARNED_CV = (*SPLIT, *GROUPED_CV, *RANDOM_CV, *learned_cv("g", GROUPED, "gcv_rows", "gcv_sc"), *learned_cv("r", RANDOM, "rcv_rows", "rcv_sc"))
ORACLE["learned_cross_validation"] = "WITH RECURSIVE " + ",\n".join(LEARNED_CV) + "\nSELECT model, split, " + ", ".join(
    f"round({c}, 9) AS {c}" for c in _CV_COLUMNS) + " FROM (SELECT * FROM gl UNION ALL SELECT * FROM rl)"
ORACLE["best_model"] = "WITH RECURSIVE " + ",\n".join(LEARNED_CV) + f"""
SELECT model, round(best, 6) AS macro_f1_mean FROM (SELECT model, macro_f1_mean AS best FROM gcv WHERE model <> {q(BASELINE)}
  UNION ALL SELECT model, macro_f1_mean FROM gl) ORDER BY best DESC, model LIMIT 1"""
# The test rows are the part that the one model leaves out.
LEARNED = (*SPLIT, *MODEL[:2], "both_ AS (SELECT *, 0 AS fold FROM train UNION ALL SELECT *, 1 FROM test)",
           "one_ AS (SELECT 1 AS fold, * FROM scales)", *logistic("lg", "both_", "one_", {LOGISTIC: FEATURES}))
ORACLE["logistic_scores"] = "WITH RECURSIVE " + ",\n".join((*LEARNED, macro("lg_p", "", "lg_f"))) + """
SELECT round(accuracy, 9) AS accuracy, round(macro_f1, 9) AS macro_f1 FROM lg_f"""
ORACLE["logistic_coefficients"] = "WITH RECURSIVE " + ",\n".join(LEARNED) + f"""
SELECT CAST(y AS INTEGER) AS ord, {CLASSES}[y + 1] AS label, {FEATURES}[j + 1] AS feature,
  round(w[y * {len(FEATURES) + 1} + j + 1], 5) + 0.0 AS coefficient
FROM lg_w CROSS JOIN (SELECT unnest(range({len(CLASSES)})) AS y) CROSS JOIN (SELECT unnest(range({len(FEATURES)})) AS j)"""
PERMUTED = (f"""base AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':rows:{EV.seed}'), id) AS r FROM test)""",
            f"""cells AS (SELECT f AS feature, dim, rep FROM (VALUES {', '.join(f"({q(c)}, {i + 1})" for i, c in enumerate(FEATURES))}) AS v(f, dim)
  CROSS JOIN (SELECT unnest(range({EV.repeats})) AS rep))""",
            f"""donors AS (SELECT feature, dim, rep, x AS value, row_number() OVER (PARTITION BY feature, rep
    ORDER BY md5(CAST(id AS VARCHAR) || ':' || feature || ':' || CAST(rep AS VARCHAR) || ':{EV.seed}'), id) AS r
  FROM el JOIN cells USING (dim))""",
            """mixed AS (SELECT d.feature, d.rep, b.id, b.epoch, l.dim, CASE WHEN l.dim = d.dim THEN d.value ELSE l.x END AS x
  FROM base b JOIN donors d USING (r) JOIN el l ON l.id = b.id)""",
            """mdist AS (SELECT feature, rep, id, epoch, label, sqrt(sum(((x - mean) / scale - centroid) ** 2)) AS d
  FROM mixed JOIN scales USING (dim) JOIN centroids USING (dim) GROUP BY ALL)""",
            """mp AS (SELECT feature, rep, epoch AS truth, label AS pred FROM (SELECT *,
  row_number() OVER (PARTITION BY feature, rep, id ORDER BY d, label) AS k FROM mdist) WHERE k = 1)""",
            macro("mp", "feature, rep", "ms"), SCORES)
ORACLE["permutation_importance_centroid"] = with_(*SPLIT, *MODEL, *PERMUTED, select=f"""
SELECT feature, round(avg(i - macro_f1), 6) AS importance_mean, round(stddev_pop(i - macro_f1), 6) AS importance_sd
FROM ms CROSS JOIN (SELECT macro_f1 AS i FROM sc WHERE model = {q(CENTROID)}) GROUP BY feature""")
ORACLE["summary_record"] = with_(*SPLIT, *MODEL, SCORES, select=f"""
SELECT (SELECT count(*) FROM fin) AS n_texts, (SELECT count(DISTINCT author) FROM fin) AS n_authors,
  (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM test) AS n_test, {q(CENTROID)} AS best_model,
  (SELECT round(accuracy, 6) FROM sc WHERE model = {q(CENTROID)}) AS test_accuracy,
  (SELECT round(macro_f1, 6) FROM sc WHERE model = {q(CENTROID)}) AS test_macro_f1,
  (SELECT round(accuracy, 6) FROM sc WHERE model = {q(BASELINE)}) AS baseline_test_accuracy""")
