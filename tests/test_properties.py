"""Invariants: results do not depend on partitioning; metrics agree with a NumPy reference."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import profile as P
from tessera.operators.metrics import regression_metrics
from tessera.operators.select import f_scores
from tessera.plans.views import order_features

from .conftest import SF_SMALL, rows


def _approx_rows(a, b):
    assert len(a) == len(b)
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float):
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9)
            else:
                assert x == y


@pytest.mark.parametrize("parts", [1, 7])
def test_profiles_independent_of_partitioning(spark, parts):
    of = order_features(spark, SF_SMALL)
    base = {
        "describe": rows(P.describe_all(of, ["lines_qty", "c_acctbal", "n_name"])),
        "nulls": rows(P.null_counts(of)),
        "dups": rows(P.duplicate_count(of.select("n_name", "o_orderstatus"))),
        "f": rows(f_scores(of, ["c_acctbal", "lines_value"], "o_totalprice")),
    }
    shuffled = of.repartition(parts)
    other = {
        "describe": rows(P.describe_all(shuffled, ["lines_qty", "c_acctbal", "n_name"])),
        "nulls": rows(P.null_counts(shuffled)),
        "dups": rows(P.duplicate_count(shuffled.select("n_name", "o_orderstatus"))),
        "f": rows(f_scores(shuffled, ["c_acctbal", "lines_value"], "o_totalprice")),
    }
    for k in base:
        _approx_rows(base[k], other[k])


finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(finite, finite), min_size=2, max_size=40))
def test_metrics_match_numpy(spark, pairs):
    y = np.array([a for a, _ in pairs])
    p = np.array([b for _, b in pairs])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "y double, p double").repartition(3)
    m = regression_metrics(df, "y", "p").first()
    mse = np.mean((y - p) ** 2)
    assert m["mse"] == pytest.approx(mse, rel=1e-9, abs=1e-9)
    assert m["mae"] == pytest.approx(np.mean(np.abs(y - p)), rel=1e-9, abs=1e-9)
    sst = np.sum((y - y.mean()) ** 2)
    if sst == 0:
        assert m["r2"] == (1.0 if mse == 0 else 0.0)
    elif sst > 1e-6:
        assert m["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / sst, rel=1e-6, abs=1e-6)
