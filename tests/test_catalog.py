"""Every oracle query against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import offer_queries
from check_oracle import TABLES, rows_of
from switchflow.session import materialize

NAMES = list(entry.oracle_sql())


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.fixture(scope="module", autouse=True)
def shared_frames():
    """The frames that many queries start from are computed once for all of them."""
    kept, patch = {}, pytest.MonkeyPatch()

    def once(name):
        make = getattr(offer_queries, name)

        def get(spark, d):
            if name not in kept:
                kept[name] = materialize(make(spark, d), name)
            return kept[name]

        return get

    for name in ("held_offers", "data", "fitted_frame"):
        patch.setattr(offer_queries, name, once(name))
    patch.setattr(offer_queries, "saved", offer_queries.data)
    yield
    patch.undo()


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
