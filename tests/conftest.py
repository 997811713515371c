from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lettings import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lettings-tests-"),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
