import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from odd import SCHEMA, odd_documents  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(autouse=True, scope="module")
def released(spark):
    """Staged tables go when a module's tests are over."""
    yield
    from dialstat.llm.staging import release

    release(spark)
