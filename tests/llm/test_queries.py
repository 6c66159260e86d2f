"""Every registered text query runs over a whole table, and equals its SQL if it has any."""

import os

import duckdb
import pytest

from basketry.llm import catalog

@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows(spark, sf, name):
    rows = catalog.queries()[name](spark, sf).count()
    if name.startswith(("op3", "op6", "op11")):
        assert rows > 0
    else:
        assert rows == spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t + '.parquet')}')")
    got = catalog.queries()[name](spark, sf)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    clean = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)
    assert clean(tuple(r) for r in got.select(*columns).collect()) == clean(want)
