from __future__ import annotations

import pytest

from tests.sessions import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture()
def settings(spark):
    """Set options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("_", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
