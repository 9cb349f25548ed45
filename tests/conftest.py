import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    import oracle_check

    return oracle_check.session()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*order).collect()]
