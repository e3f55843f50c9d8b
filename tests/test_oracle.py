"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); queries without an oracle must run."""
import pytest

from tessera.plans import REGISTRY
from tessera.plans.oracle import compare, duck

SF_SMALL = "/root/testdata/sf0.001"

# ML fits are exercised by test_models.py; they take longer than the rest.
ML = {k for k, q in REGISTRY.items() if q.sql is None}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(k for k in REGISTRY if k not in ML))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, SF_SMALL, con)
    assert ok, f"{key}: {msg}"


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert df.columns == [c for c, _ in REGISTRY[E.FLAGSHIP].cols]
