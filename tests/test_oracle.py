"""Every registered query against the equivalent SQL, on the whole small tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, SQL = queries(), oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    return float(value) if type(value).__name__ in ("Decimal", "int", "float", "bool") else value


def rows_of(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if not name.startswith("op"):  # operators for training data may run Python where it serves
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [bad for bad in ("Python", "Pandas", "Arrow", "CartesianProduct") if bad in plan]
    rel = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        assert TYPES[f.dataType.simpleString()] == types[f.name] or "DECIMAL" in types[f.name]
    order = [rel.columns.index(c) for c in columns]
    assert rows_of([r[c] for c in columns] for r in df.collect()) == rows_of([r[i] for i in order] for r in rel.fetchall())


def test_queries_without_sql_are_those_with_forests():
    assert {n for n in set(QUERIES) - set(SQL) if n != "pipeline" and not n.startswith("op")} == {"forest_scores", "experiment_summary"}
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
