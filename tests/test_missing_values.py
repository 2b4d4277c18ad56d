"""NaN counts as missing everywhere; CSV lines with surplus values stop the job."""

from __future__ import annotations

import math

import pytest

from tessera.functions.columns import safe_name
from tessera.operators import clean as C
from tessera.operators import profile as P
from tessera.operators import transform as M
from tessera.operators.select import f_scores, select_k
from tessera.sources import readers as R

from .conftest import rows

NAN = float("nan")


@pytest.fixture(scope="module")
def frames(spark):
    """The same rows with NaN and with NULL."""
    data = [(1, 1.0, "a", 2.0), (2, 3.0, "a", 6.5), (3, NAN, "a", 4.0), (4, 5.0, "b", 9.0), (5, 9.0, "b", 20.0)]
    schema = "k long, x double, g string, y double"
    return (spark.createDataFrame(data, schema),
            spark.createDataFrame([tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in data], schema))


@pytest.mark.parametrize("what", [
    lambda d: P.null_counts(d),
    lambda d: P.missing_profile(d),
    lambda d: P.column_info(d),
    lambda d: P.describe_numeric(d, ["x"]),
    lambda d: P.histogram(d, "x", bins=4),
    lambda d: P.mean_of(d, "x"),
    lambda d: P.null_rows(d, "x").select("k"),
    lambda d: C.impute_group_mean(d, "x", "g"),
    lambda d: f_scores(d, ["x"], "y"),
    lambda d: M.fit_transformer(d, {"features": {"continuous": ["x"]},
                                    "preprocessing": {"scaling": {"method": "standard", "apply_to": ["continuous"]}}}),
])
def test_nan_and_null_give_the_same_rows(frames, what):
    with_nan, with_null = (sorted(map(str, what(d).collect())) for d in frames)
    assert with_nan == with_null and not any("nan" in r for r in with_nan)


def test_a_nan_feature_is_not_ranked_first(frames):
    df = frames[0].withColumn("z", frames[0]["y"])
    assert [r[1] for r in rows(select_k(f_scores(df, ["x", "z"], "y"), 1), "position", "feature")] == ["z"]


def test_surplus_values_stop_the_read(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('a,b\n1,x\n2\n3,"y, ""z"""\n')
    bad.write_text("a,b\n1,x\n3,x,EXTRA\n")
    assert rows(R.read_table(spark, str(good)), "a", "b") == [("1", "x"), ("2", None), ("3", 'y, "z"')]
    assert R.read_table(spark, str(good)).count() == 3
    for take in (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("a").collect()):
        with pytest.raises(Exception, match="Expected 2 values"):
            take(R.read_table(spark, str(bad)))


def test_output_names_never_meet():
    assert len({safe_name(v) for v in ("1.5", "1_5", "1%2E5", "1`5", "1%5")}) == 5
