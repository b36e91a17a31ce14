import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)



@pytest.fixture(scope="session")
def spark():
    from driftsweep.session import local_session

    s = local_session("*", app="driftsweep-tests",
                      extra={"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_spark(tmp_path):
    return str(tmp_path)
