import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    return local_session(**{"spark.checkpoint.dir": shared_folder})


@pytest.fixture
def lake(tmp_path):
    from tillflow.sources.lake import Lake

    return Lake(str(tmp_path / "lake"))
