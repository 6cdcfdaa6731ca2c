from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from vendorium.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not Path(SF_DIR).exists():
        pytest.skip("test tables are not here")
    return SF_DIR
