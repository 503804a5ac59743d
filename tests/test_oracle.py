"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from compare import same_result
from conftest import SF_SMALL
from loadcast import registry

ORACLES = registry.oracle_sql()  # the training-data queries have their own tests
QUERIES = {n: q for n, q in entry.queries().items() if n in registry.queries()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = same_result(QUERIES[name](spark, SF_SMALL), duck.execute(ORACLES[name]))
    assert ok, msg


def test_every_query_but_learning_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == {"gbt_forecast"}


def test_entry_returns_rows_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 32
    assert df.columns[:3] == ["timestamp_utc", "group_id", "target_consumption"]


def test_oracles_do_not_depend_on_the_duckdb_time_zone():
    import duckdb

    from compare import canonical_rows
    from conftest import TABLES

    def digests(tz):
        con = duckdb.connect()
        con.execute(f"SET TimeZone='{tz}'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        out = {}
        for n, q in ORACLES.items():
            r = con.execute(q)
            out[n] = canonical_rows([d[0] for d in r.description], r.fetchall())
        return out

    assert digests("UTC") == digests("Asia/Kolkata")
