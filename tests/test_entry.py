import duckdb
import pytest

import __spark_entry__ as entry

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck(data):
    from pathlib import Path

    c = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def _norm(v):
    return float(f"{float(v):.9g}") if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    cols = sorted(df.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = entry.oracle_sql().get(name)
    if sql:
        got = duck.execute(sql)
        names = [x[0] for x in got.description]
        assert sorted(names) == cols
        assert rows == sorted((tuple(_norm(r[names.index(c)]) for c in cols) for r in got.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
