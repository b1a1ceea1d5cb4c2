import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from evalspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def apply(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, str(value))

    yield apply
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def rows(df, *order):
    """Rows as tuples, ordered by columns (all of them without names)."""
    got = [tuple(r) for r in df.collect()]
    if order:
        places = [df.columns.index(c) for c in order]
        return sorted(got, key=lambda r: [repr(r[p]) if r[p] is None else r[p] for p in places])
    return sorted(got, key=repr)
