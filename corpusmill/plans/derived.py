"""Tables that Spark derives from the given ones, as inputs of the queries.

The statements run unchanged in Spark and in the checking engine. Death years
follow from the author's name, so an author belongs to one epoch.
"""

CATALOG = """
SELECT CAST(doc_id AS STRING) AS text_no,
       CASE WHEN doc_id % 23 = 0 THEN 'Sound' ELSE 'Text' END AS type,
       CASE WHEN doc_id % 17 = 0 THEN 'en; de' ELSE lang END AS language,
       CASE WHEN v < 5 THEN 'Effi  Briest: Band ' ELSE 'EFFI BRIEST, Band ' END
         || CAST(v % 4 AS STRING) AS title,
       CASE v
         WHEN 0 THEN a || CAST(b AS STRING) || '?-' || CAST(b + 60 AS STRING)
         WHEN 1 THEN a || CAST(b AS STRING) || '-'
         WHEN 2 THEN a || CAST(b AS STRING) || '-' || CAST(b + 60 AS STRING) || '; Meyer, Hans, 1850-1920 [Editor]'
         WHEN 3 THEN a || CAST(b AS STRING) || '-' || CAST(b + 60 AS STRING) || '; Scheibe, A., 1800-1870 [Translator]'
         WHEN 4 THEN 'Anonymous'
         WHEN 5 THEN a || CAST(b AS STRING) || '-' || CAST(b + 60 AS STRING) || ' [Illustrator]'
         ELSE a || CAST(b AS STRING) || '-' || CAST(b + 60 AS STRING) END AS authors,
       CASE CAST(doc_id % 7 AS INT) WHEN 0 THEN 'Drama' WHEN 1 THEN 'Die Preise' WHEN 2 THEN NULL
         ELSE 'Fiction' END AS subjects,
       CASE CAST(doc_id % 5 AS INT) WHEN 0 THEN 'PR' WHEN 1 THEN 'PR; PT' ELSE 'PT' END AS locc,
       CASE WHEN doc_id % 13 = 0 THEN 'Gedichte' ELSE NULL END AS bookshelves
FROM (SELECT doc_id, lang, CAST(floor(doc_id / 20) AS INT) % 10 AS v,
             'Autor' || substr(source, 4) || '.' || CAST(CAST(floor(doc_id / 200) AS INT) % 5 AS STRING)
               || ', Vorname, ' AS a,
             1640 + CAST(substr(source, 4) AS INT) * 18 + CAST(floor(doc_id / 200) AS INT) % 5 AS b
      FROM {documents}) d
"""

BOOKS = """
SELECT doc_id AS id, lang,
       CASE CAST(doc_id % 11 AS INT)
         WHEN 0 THEN body
         WHEN 1 THEN 'Licence text' || chr(10) || '*** START OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10) || body
         WHEN 2 THEN replace('Licence' || chr(10) || '***START OF THIS PROJECT GUTENBERG E-BOOK X***' || chr(10)
              || body || chr(10) || '*** END OF THIS PROJECT GUTENBERG E-BOOK X ***' || chr(10) || 'More',
              chr(10), chr(13) || chr(10))
         WHEN 3 THEN '*** END OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10)
              || '*** START OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10) || body
         ELSE 'Licence' || chr(10) || '*** START OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10) || body || chr(10)
              || '*** END OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10) || 'More' END AS raw
FROM (SELECT doc_id, lang,
             CASE WHEN doc_id % 3 = 0 THEN 'Kapitel _eins_' || chr(10) || '[Illustration: Ein' || chr(10) || 'Mann]'
               || chr(10) || chr(10) || '* * * * *' || chr(10) || chr(10) ELSE '' END
             || replace(text, chr(10), chr(10) || chr(10)) AS body
      FROM {documents}) d
"""

# Every sentence of a text introduces its first word as a person.
CUED = """
SELECT doc_id, 'Frau ' || replace(text, '. ', '. Frau ') AS text FROM {documents}
"""

# Four measures that take in every entry of a vector: means of sixteen each.
# Sums of sixteen single-precision numbers are exact in double precision, so
# their order does not matter. One spelling per engine.
_HEAD = """
SELECT vec_id AS id, 'A' || CAST(label AS STRING) || '_' || CAST(vec_id % 6 AS STRING) AS author,
       'E' || CAST(label % 3 AS STRING) AS epoch, """
FEATURES_SPARK = _HEAD + ", ".join(
    f"aggregate(slice(embedding, {16 * i + 1}, 16), CAST(0 AS DOUBLE), (a, x) -> a + CAST(x AS DOUBLE)) / 16 AS f{i + 1}"
    for i in range(4)) + " FROM {embeddings}"
FEATURES_DUCKDB = _HEAD + ", ".join(
    f"list_sum(list_transform(embedding[{16 * i + 1}:{16 * i + 16}], lambda x: CAST(x AS DOUBLE))) / 16 AS f{i + 1}"
    for i in range(4)) + " FROM embeddings"
