"""Run a named query and its SQL twin and compare the results as bags."""

from collections import Counter

import duckdb

TABLES = ("customer", "events", "orders")


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(row) for row in df.collect()])


def sql_bag(con, sql):
    result = con.execute(sql)
    return bag([d[0] for d in result.description], result.fetchall())


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def spark_types(df):
    return {name: KINDS[kind] for name, kind in df.dtypes}


def sql_types(con, sql):
    return {d[0]: str(d[1]) for d in con.execute(sql).description}
