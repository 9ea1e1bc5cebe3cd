"""Shared fixtures: one local Spark session, UTC, few shuffle partitions, UI off."""
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from refinery.session import build_session, work_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, app="refinery-tests")
    yield session
    session.stop()


@pytest.fixture
def tmp_root(spark, request):
    return work_dir(spark, request.node.name[:40])

