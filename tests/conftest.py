import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="tidemark-test-wh-")
    s = get_session("tests", master="local[4]", shuffle_partitions=4,
                    extra={"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
                           "spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidemark-test-")
