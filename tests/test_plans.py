"""Plan-shape checks and every registered query against its SQL oracle (sf0.001)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tessera.plans import catalog  # noqa: E402

from .conftest import SF_SMALL  # noqa: E402
from .oracle_check import digest, type_diff  # noqa: E402

# Composed jobs run many actions while being planned; they are covered in test_jobs.
PLANNED = [n for n in catalog.QUERIES if not n.startswith("l")]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


REDUCED = ("HashAggregate(", "ObjectHashAggregate(", "SortAggregate(", "LocalLimit", "TakeOrderedAndProject")


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_udf_and_no_single_partition(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # Only pre-reduced data (a partial aggregate's one row per task, or a per-task
            # limit) may be gathered into one partition; never raw rows for a global window/sort.
            child = lines[i + 1] if i + 1 < len(lines) else ""
            assert any(k in child for k in REDUCED), f"unreduced rows gathered into one task:\n{child}"


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(queries()["f5_drop_null_rows"](spark, SF_SMALL))
    assert "PushedFilters" in plan or "IsNotNull" in plan
    scan = _plan(queries()["p1_duplicate_rows"](spark, SF_SMALL))
    assert "l_extendedprice" not in scan     # only the two projected columns are read


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from tessera.plans.views import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert type_diff(sdf, duck, oracle_sql()[name]) == {}
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_staged_training_input_prunes_partitions_and_columns(spark):
    from pyspark.sql import functions as F

    from tessera.operators.split import split
    from tessera.plans.views import order_features
    from tessera.session import materialize
    staged = materialize(split(order_features(spark, SF_SMALL), "o_orderkey"), partition_by=["split"])
    plan = _plan(staged.where(F.col("split") == "train").select("c_acctbal"))
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan and "= train)" in plan
    assert "ReadSchema: struct<c_acctbal:double>" in plan
