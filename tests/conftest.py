import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import local_session
    s = local_session("*", 8, app="vigil-tests")
    yield s


@pytest.fixture
def tiny_buckets(monkeypatch):
    """Force multi-level bucket refinement and hot-tie splitting on small data."""
    from vigil.operators import primitives
    monkeypatch.setattr(primitives, "MIN_BUCKET_ROWS", 7)
    monkeypatch.setattr(primitives, "DEFAULT_BOUNDS", 4)
    yield
