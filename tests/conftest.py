import os
import sys
from pathlib import Path

os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from dialstat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(8, shuffle_partitions=8, app="dialstat-tests", checkpoint_dir=scratch)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frames(spark):
    """Build small DataFrames from lists of tuples and a DDL schema."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
