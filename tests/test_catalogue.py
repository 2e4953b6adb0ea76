import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from catalogue.fixtures import TABLES, VIEWS, view

# A spread of families; tools/check.py compares every query.
SAMPLE = ["mapping_log", "parse_times", "take_until_target", "star_enrichment", "paragraph_chunks", "first_valid", "ttl_dedup", "unseen_urls"]


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_views_agree(spark, sf, con, name):
    from catalogue.fixtures import DEPENDS, DUCKDB_ONLY

    heads = ", ".join(f"{n} AS ({DUCKDB_ONLY.get(n, VIEWS[n])})" for n in [*DEPENDS.get(name, []), name])
    cursor = con.execute(f"WITH {heads} SELECT * FROM {name}")
    want = rows_of(cursor.fetchall(), [d[0] for d in cursor.description])
    df = view(spark, sf, name)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == want


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf, con, name):
    cursor = con.execute(oracle_sql()[name])
    want = rows_of(cursor.fetchall(), [d[0] for d in cursor.description])
    df = queries()[name](spark, sf)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == want
