import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlib.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", 4, 4)


@pytest.fixture()
def rows(spark):
    """``rows(schema, [...])`` makes a DataFrame, ``rows.sorted(df)`` its sorted tuples."""
    def make(schema, data):
        return spark.createDataFrame(data, schema)

    make.sorted = lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
    return make
