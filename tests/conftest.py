import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))

from jobweft.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "jobweft-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
