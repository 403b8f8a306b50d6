import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from oreflow.session import clear_scratch, local_session

    session = local_session("*", shuffle_partitions=8, app="oreflow-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def place(spark):
    """A new scratch folder per name."""
    from oreflow.session import scratch_dir

    return lambda name: scratch_dir(spark, f"test-{name}")


def rows(df, *columns):
    """Sorted tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
