import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from egolake.session import let_workers_import, session

    s = session("tests", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="4g", spark_ui_showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    let_workers_import(s)
    yield s
    s.stop()


DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
