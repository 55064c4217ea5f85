import pathlib
import sys
import tempfile

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from signalstats.session import session_builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="signalstats-test-"),
    }
    session = session_builder("signalstats-tests", **settings).master("local[4]").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
