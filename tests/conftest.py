import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from creditloom.session import local_session, tune  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = tune(local_session(cores=8, app="tests", spark__sql__shuffle__partitions="4"))
    yield session
    session.stop()
