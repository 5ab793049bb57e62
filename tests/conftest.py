import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weirflow.session import build_session

    session = build_session("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_rows(spark):
    """Lower the size from which a group is split, so that small data takes the hot-key path."""
    from weirflow.operators.ordering import SPLIT_ROWS_CONF

    def to(rows):
        spark.conf.set(SPLIT_ROWS_CONF, str(rows))

    yield to
    spark.conf.unset(SPLIT_ROWS_CONF)


@pytest.fixture
def rows_of():
    def get(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

    return get
