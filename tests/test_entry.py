"""The driver's entry point: what is registered, and each query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")


def test_entry(spark):
    assert [r.stage for r in entry.entry(spark).collect()] == ["page_view", "add_to_cart", "checkout_start", "purchase"]


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _values(rows, names):
    clean = lambda v: None if v is None else round(v, 6) if isinstance(v, float) else str(v) if hasattr(v, "year") else v
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(str([clean(r[i]) for i in order]) for r in rows)


def test_queries_equal_their_sql(spark):
    import duckdb

    from eventloom.plans import queries as events

    db = duckdb.connect()
    for f in os.listdir(DIR):
        db.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    wrong = []
    for name, sql in events.oracle_sql().items():
        got, want = events.queries()[name](spark, DIR), db.execute(sql)
        names = [c[0] for c in want.description]
        if sorted(got.columns) != sorted(names) or _values(got.collect(), got.columns) != _values(want.fetchall(), names):
            wrong.append(name)
    assert not wrong
