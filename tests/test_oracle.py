"""Every registered query that has SQL gives what DuckDB gives, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def value(x):
    return None if x is None or x != x else float(x) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    ours = entry.queries()[name](spark, DATA)
    columns = sorted(ours.columns)
    theirs = duck.sql(SQL[name]).df()
    assert sorted(theirs.columns) == columns
    rows = lambda df: sorted(tuple(map(str, map(value, r))) for r in df[columns].itertuples(index=False))
    assert rows(ours.toPandas()) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).columns == ["tier", "n", "words"]


def test_every_reason_fires(spark):
    found = {r["reason"] for r in entry.queries()["page_reasons"](spark, DATA).distinct().collect()}
    assert {"accepted", "empty-title", "namespace-title", "list-article", "redirect", "disambiguation", "stub", "quality-template", "promo-category", "promo-title", "year-title", "date-title", "episode-title", "deletion-banner", "too-short", "link-heavy"} <= found
