from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ticketmill.plans.session import local_session  # noqa: E402
from ticketmill.schemas import BRONZE, ROW_ID  # noqa: E402
from ticketmill.sources import reference_data  # noqa: E402

AS_OF = "2026-06-10 00:00:00"
GOOD = ("alice_1@example.org", "2026-06-01 10:00:00", "How do I reset it?", "JP-TOKYO", None)


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def regions(spark):
    return reference_data.dim_regions(spark)


@pytest.fixture(scope="session")
def categories(spark):
    return reference_data.dim_categories(spark)


@pytest.fixture
def bronze(spark):
    """Bronze tables from rows of the five raw columns, numbered in order."""

    def build(rows, **extra):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        columns = f"{ROW_ID} long, " + ", ".join(f"{f.name} string" for f in BRONZE.fields)
        return spark.createDataFrame(numbered, columns)

    return build


def ticket(**changes):
    """A valid raw row with some of its columns changed."""
    return tuple({**dict(zip(BRONZE.names, GOOD)), **changes}.values())


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
