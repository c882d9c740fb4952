"""Every registered query against its DuckDB oracle at sf0.01 (rows-only when
there is no oracle)."""
import pytest

from tickweave.plans import registry
from oracle_harness import compare, duck

from paths import SF01

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_sql_key_is_registered():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    df = QUERIES[key](spark, SF01)
    if key in SQL:
        ok, msgs, _, _ = compare(df, con, SQL[key])
        assert ok, msgs
    else:
        rows = df.collect()
        assert rows and all(x is not None for r in rows for x in r), key
