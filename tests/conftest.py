import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from kinloom.session import local_session, ship_package

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    ship_package(session)
    yield session
    session.stop()
