"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(table):
    """Columns by name, rows sorted, as plain values, with the types next to them."""
    names = sorted(table.column_names)
    rows = list(zip(*[table.column(n).to_pylist() for n in names])) if names else []
    rows.sort(key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])
    types = {
        n: str(table.schema.field(n).type).replace("large_", "") for n in names
    }
    return names, types, rows


def assert_same(spark_df, con, sql):
    names, types, rows = normal(spark_df.toArrow())
    want_names, want_types, want_rows = normal(con.sql(sql).to_arrow_table())
    assert names == want_names
    assert types == want_types
    assert len(rows) == len(want_rows)
    for got, want in zip(rows, want_rows):
        assert got == want
