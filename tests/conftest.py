import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airtally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    session = local_session(8, shuffle_partitions=4, memory="6g", shared_folder=shared_folder)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples; NULLs come first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect


@pytest.fixture
def games(spark):
    from airtally.schemas import GAME_INFO

    def make(*dicts):
        names = GAME_INFO.fieldNames()
        return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], GAME_INFO)

    return make


@pytest.fixture
def streamers(spark):
    from airtally.schemas import STREAMER_INFO

    def make(*dicts):
        names = STREAMER_INFO.fieldNames()
        return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], STREAMER_INFO)

    return make
