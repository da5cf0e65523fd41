import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import session

    folders = {"spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")), "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared"))}
    s = session("tests", spark__sql__shuffle__partitions="4", **folders)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
