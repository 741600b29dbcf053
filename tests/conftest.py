import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from kerbline.session import local_session

    session = local_session(cpus=8, memory="8g", app="kerbline-tests")
    yield session
    session.stop()
