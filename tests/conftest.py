"""Shared session and helpers."""

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from carelake.session import local_session  # noqa: E402
from carelake.sources import schemas  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "4")


@pytest.fixture(scope="session")
def resource_rows(spark):
    """Nested resource frame from Python dicts."""

    def make(resource, *rows):
        df = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string")
        return df.select(F.from_json("j", schemas.resource_schema(resource)).alias("r")).select("r.*")

    return make


def dicts(df, *order):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: [str(r[c]) for c in order]) if order else rows
