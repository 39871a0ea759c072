"""Every operator's query against its SQL twin, and the entry points."""

from collections import Counter

import duckdb
import pytest
from compare import spark_types, sql_types

import __spark_entry__ as contract
from stampcard.llm.oracles import ORACLES
from stampcard.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_entry_has_one_query_for_each_operator_and_the_pipeline():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duck(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    assert spark_types(df) == sql_types(con, ORACLES[name])
    columns = df.columns
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert Counter(got) == Counter(want)
    assert got
