from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridlake.session import local_session, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder under the session's checkpoint root."""
    return scratch_path(spark, "test")


def write_text(path: str, text: str) -> str:
    p = Path(path.removeprefix("file:"))
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text, encoding="utf-8")
    return str(p)
