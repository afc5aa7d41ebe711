from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("SNAPLEDGER_DRIVER_MEMORY", "3g")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from snapledger.session import get_session

    session = get_session("tests", cores=4, shuffle_partitions=4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as a sorted list of tuples (None first)."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda t: tuple((v is not None, str(v)) for v in t))
