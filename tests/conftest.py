import sys

import pytest

from paths import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cellar.session import get_session
    session = get_session(master="local[*]", shuffle_partitions=8, app_name="cellar-tests")
    yield session
    session.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
