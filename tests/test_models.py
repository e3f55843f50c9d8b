"""Model / selection queries: determinism, row counts and metric bounds."""
import pytest

from tessera.plans import REGISTRY

SF_SMALL = "/root/testdata/sf0.001"

ML = sorted(k for k, q in REGISTRY.items() if q.sql is None)


@pytest.mark.parametrize("key", ML)
def test_model_query_runs(spark, key):
    rows = REGISTRY[key].build(spark, SF_SMALL).collect()
    assert len(rows) > 0


def test_adversarial_auc_is_a_probability(spark):
    (row,) = REGISTRY["v08_adversarial_validation"].build(spark, SF_SMALL).collect()
    assert 0.0 <= row["auc"] <= 1.0


def test_segment_models_deterministic(spark):
    a = sorted(REGISTRY["k12_segment_models"].build(spark, SF_SMALL).collect())
    b = sorted(REGISTRY["k12_segment_models"].build(spark, SF_SMALL).collect())
    assert a == b
