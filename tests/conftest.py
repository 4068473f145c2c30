import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from lamplight.session import local_session

    return local_session(cores=4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def data():
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test tables")
    return DATA
