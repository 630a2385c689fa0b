import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="strata-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-ckpt-"),
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
