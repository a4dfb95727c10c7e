"""The entry module: every query has a statement, and the flagship agrees with its own."""

import duckdb
import pytest

import __spark_entry__ as entry
from haulwright.plans.queries import QUERIES
from oracles.queries import ORACLES


def shown(row):
    """Values with floats to nine decimals."""
    return tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in row)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_duckdb(spark, folder, name):
    db = duckdb.connect()
    for table in ("events", "region", "nation", "supplier", "customer"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    got = entry.queries()[name](spark, folder).select(*columns).collect()
    spark.catalog.clearCache()
    assert sorted(map(shown, got), key=repr) == sorted(map(shown, cursor.fetchall()), key=repr)


def test_flagship_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_courses_reach_the_rules_that_rounds_seldom_show():
    db = duckdb.connect()
    for table in ("events", "region", "nation", "supplier", "customer"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.01/{table}.parquet'")
    reached = {row[1] for row in db.execute(ORACLES["rule_coverage"]).fetchall()}
    assert {"L3", "L12", "L16", "L17", "L18", "L20", "L22", "U10", "U11", "T3", "X1", "X4", "X6"} <= reached


def test_two_runs_share_one_index(spark, folder, monkeypatch):
    from haulwright.plans import enrich
    from haulwright.plans.queries import QUERIES

    built, build = [], enrich.PlaceIndex.build
    monkeypatch.setattr(enrich.PlaceIndex, "build", staticmethod(lambda *a, **k: built.append(1) or build(*a, **k)))
    assert QUERIES["cycles_current_merged"](spark, folder).columns
    assert len(built) == 1
