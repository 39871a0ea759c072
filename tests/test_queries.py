"""Every named query against its SQL twin, values and types."""

import pytest
from compare import duck, spark_bag, spark_types, sql_bag, sql_types

import __spark_entry__ as contract
from stampcard.plans import registry

QUERIES = {name: query for name, query in contract.queries().items() if name in registry.QUERIES}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in registry.QUERIES}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duck(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    assert spark_types(df) == sql_types(con, ORACLES[name])
    columns, rows = spark_bag(df)
    sql_columns, sql_rows = sql_bag(con, ORACLES[name])
    assert columns == sql_columns
    assert rows - sql_rows == {} and sql_rows - rows == {}
    assert sum(rows.values()) > 0


def test_marks_expire_between_the_streams_batches(sf_dir):
    """Some copies pass a second time in the third batch, all batches count."""
    con = duck(sf_dir)
    passed, keys = con.execute(
        f"SELECT count(*), count(DISTINCT (user_id, event_id)) FROM ({ORACLES['dedup_stream_available_now']})"
    ).fetchall()[0]
    assert passed > keys
    clocks = con.execute(f"SELECT count(DISTINCT processed_at) FROM ({ORACLES['live_stream_available_now']})").fetchall()
    assert clocks == [(3,)]
