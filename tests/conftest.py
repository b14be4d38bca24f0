import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hearken.session import session

    s = session("local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="4g", spark_ui_showConsoleProgress="false", spark_checkpoint_dir="file://" + str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
