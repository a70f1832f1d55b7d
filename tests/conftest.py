from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    session = local_session(cpus=4, shuffle_partitions=8, app="tidemark-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def rows(df, order=None):
    """Collect as a list of dicts, sorted for stable comparison."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[k] is None, d[k]) for k in order))
    return out
