"""Equivalent SQL (DuckDB) of the registered queries of this subpackage, where SQL can express them.

Sketches, automata, tokenizers and learned models cannot be; those queries are
held against plain Python in the tests.
"""

ORACLE: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op3_mixing"] = f"""
WITH sized AS (SELECT doc_id, source, coalesce(text, '') AS t, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size
  FROM documents),
keyed AS (SELECT *, -ln((CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
    / 4503599627370496.0) / (1 / (1 + abs(ln(greatest(length(t) / greatest(size, 1), 0.5) / 6)))) AS key FROM sized),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
weighed AS (SELECT *, 2.0 * source_size AS cap, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]
  AS DOUBLE) AS w FROM sources),
levels AS (SELECT a.cap / a.w AS per, (1.5 * (SELECT sum(source_size) FROM sources)
    - coalesce(sum(b.cap) FILTER (b.cap / b.w < a.cap / a.w), 0)) / sum(b.w) FILTER (b.cap / b.w >= a.cap / a.w) AS level
  FROM weighed a CROSS JOIN weighed b GROUP BY a.source, a.cap, a.w),
goal AS (SELECT source, source_size, least(cap, coalesce(w * (SELECT level FROM levels WHERE per >= level ORDER BY per LIMIT 1),
  cap)) AS target FROM weighed),
placed AS (SELECT k.*, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS aim,
  coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, md5(t)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN goal g ON g.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target, CAST(aim // greatest(source_size, 1) * size + greatest(0, least(size,
  aim - aim // greatest(source_size, 1) * source_size - before)) AS BIGINT) AS taken FROM placed"""

ORACLE["op8_near_duplicates"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3),
    lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS joint FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * joint >= 75 * (x.n + y.n - joint)),
reach AS (SELECT doc_id AS a, doc_id AS r FROM documents UNION SELECT reach.a, l.b FROM reach JOIN links l ON l.a = reach.r)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT a, min(r) AS component_id FROM reach GROUP BY a) c
  ON c.a = d.doc_id"""

ORACLE["op10_decontamination"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM benchmark),
windows AS (SELECT DISTINCT item, l, win FROM (
  SELECT item, least(13, len(ws)) AS l, unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2),
    lambda i: array_to_string(ws[i:i + least(13, len(ws)) - 1], ' '))) AS win FROM items WHERE len(ws) > 0)),
docs AS (SELECT doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
places AS (SELECT doc_id, l, unnest(range(1, len(ws) - l + 2)) AS i, unnest(list_transform(range(1, len(ws) - l + 2),
    lambda i: array_to_string(ws[i:i + l - 1], ' '))) AS win FROM docs CROSS JOIN (SELECT DISTINCT l FROM windows)),
found AS (SELECT doc_id, i, places.l AS l, item FROM places JOIN windows ON windows.l = places.l AND windows.win = places.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
  FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id"""

_TRIMMED = r"regexp_replace({}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"

ORACLE["op12_line_dedup"] = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS d, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT d, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM docs),
keyed AS (SELECT *, {_LOWER.format(_TRIMMED.format("line"))} AS key FROM lines),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT d) >= 10),
kept AS (SELECT d, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM keyed ANTI JOIN often USING (key) GROUP BY d)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, len(ls) - coalesce(n, 0) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON kept.d = docs.d"""


def _merkle_levels(tree: str, lowest: str, levels: int) -> str:
    """CTEs ``<lowest>0`` to ``<lowest><levels>``: the nodes of every level as ``(tree, i, n, d, run)``.

    ``run`` are the digests below a node; a tree with one node left keeps it, with an empty run.
    """
    return ", ".join(f"""
{lowest}{k} AS (SELECT {tree}, p AS i, (any_value(n) + 15) // 16 AS n,
  CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d,
  CASE WHEN any_value(n) > 1 THEN list(d ORDER BY i) ELSE [] END AS run
  FROM (SELECT *, i // 16 AS p FROM {lowest}{k - 1}) GROUP BY {tree}, p)""" for k in range(1, levels + 1))


def _merkle_fold(levels: list[str]) -> str:
    """CTEs ``f<k>``: the path of every leaf through the runs of these levels, with siblings ``sib`` and folded digest ``cur``."""
    out = []
    for k, level in enumerate(levels, 1):
        tree, place = ("source", "i") if level[0] == "s" else ("one", "si")
        at = f"(f{k - 1}.{place} // {16 ** (int(level[1:]) - 1)}) % 16"
        out.append(f"""
f{k} AS (SELECT f{k - 1}.* EXCLUDE (sib, cur), sib || CASE WHEN len(run) > 0 THEN
    array_to_string(list_concat(run[:{at}], run[{at} + 2:]), '') ELSE '' END AS sib,
  CASE WHEN len(run) > 0 THEN sha256(array_to_string(run[:{at}], '') || cur || array_to_string(run[{at} + 2:], '')) ELSE cur END AS cur
  FROM f{k - 1} JOIN {level} ON {level}.{tree} IS NOT DISTINCT FROM f{k - 1}.{tree}
    AND {level}.i = f{k - 1}.{place} // {16 ** int(level[1:])})""")
    return ", ".join(out)


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
_CRC = """xor(4294967295, list_reduce(list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii({0}[i]) AS BIGINT)), lambda c, b:
    list_reduce(range(8), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)))"""

# Enough levels for 16 million documents a source and 65,536 sources.
ORACLE["op13_merkle_manifest"] = f"""
WITH hashed AS (SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
      THEN {_LEAF.format(_FIELD.format(_LOWER.format("text")))} END AS tampered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
s0 AS (SELECT source, i, n, leaf AS d FROM placed), {_merkle_levels("source", "s", 6)},
sources AS (SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS si FROM s6),
r0 AS (SELECT 1 AS one, si AS i, count(*) OVER () AS n, subroot AS d FROM sources), {_merkle_levels("one", "r", 4)},
f0 AS (SELECT p.doc_id, p.source, p.leaf, p.i, s.subroot, s.si, 1 AS one, '' AS sib, coalesce(p.tampered, p.leaf) AS cur
  FROM placed p JOIN sources s ON s.source IS NOT DISTINCT FROM p.source),
{_merkle_fold([f"s{k}" for k in range(1, 7)] + [f"r{k}" for k in range(1, 5)])}
SELECT doc_id, leaf, subroot, r4.d AS root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = r4.d AS verified
FROM f10 JOIN r4 ON r4.one = f10.one"""
