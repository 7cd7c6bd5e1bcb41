from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from settlekit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = local_session("*", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="settlekit-warehouse-")})
    yield s
