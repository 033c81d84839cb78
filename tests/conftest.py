from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from orderlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    # Plan texts in full: columns are numbered through the session, and filters would be cut where numbers get longer.
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()
