import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)


@pytest.fixture(scope="session")
def spark():
    from riskspark.session import local_session
    s = local_session(8, "tests")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s
