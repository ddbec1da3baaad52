import os
import tempfile

import pytest

from lodestone.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lodestone-tests-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
