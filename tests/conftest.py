import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from starload.session import build_session

    # spark.checkpoint.dir comes from the environment's Spark conf; only
    # when it is unset does build_session create a private folder (local).
    wh = tempfile.mkdtemp(prefix="starload-test-wh-")
    s = build_session("local[*]", app_name="starload-tests", shuffle_partitions=8,
                      extra_conf={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def tmp_target(tmp_path):
    return str(tmp_path / "target")
