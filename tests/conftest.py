from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", app_name="tessera-tests", shuffle_partitions=4, extra={
        "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples ordered by the given (or all) columns (names taken literally)."""
    from pyspark.sql import functions as F
    names = [c.strip("`") for c in (cols or tuple(df.columns))]
    refs = [F.col("`" + n + "`") for n in names]
    return [tuple(r) for r in df.select(*refs).orderBy(*refs).collect()]
