import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from obsgate.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="obsgate-tests")
    yield s
    s.stop()


@pytest.fixture
def lines_of(spark):
    """Build a (value, file_name) frame from {file_name: text}."""

    def build(files: dict[str, str]):
        data = []
        for name, text in files.items():
            for line in text.split("\n"):
                data.append((line, name))
        return spark.createDataFrame(data, "value string, file_name string")

    return build
