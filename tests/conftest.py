from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from formweave.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="formweave-test-ckpt-")
    s = get_spark("local[*]", app="formweave-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ckpt,
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="formweave-test-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE_DIR


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="formweave-test-")
