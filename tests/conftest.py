import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from workload.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g")
    assert session.conf.get("spark.sql.ansi.enabled") == "true"
    return session
