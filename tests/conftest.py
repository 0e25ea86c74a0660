from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelpay.session import local_session  # noqa: E402
from parcelpay.sources.schemas import SCHEMAS  # noqa: E402
from parcelpay.sources.tables import ReportTables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "parcelpay-tests", shuffle_partitions=2)
    # Compiling code for a handful of rows takes longer than running them.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Input tables from dictionaries; columns left out are NULL."""

    def build(**rows):
        def frame(name):
            ddl = SCHEMAS[name]
            names = [part.strip().split(" ")[0] for part in ddl.split(",")]
            values = [tuple(row.get(n) for n in names) for row in rows.get(name, [])]
            return spark.createDataFrame(values, ddl)

        return ReportTables(frame)

    return build


@pytest.fixture
def conf(spark):
    """Change session settings for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
