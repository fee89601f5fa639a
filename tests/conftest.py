import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from claimsieve.session import local_session  # noqa: E402
from claimsieve.sources.claims import CLAIM_SCHEMA  # noqa: E402

# Two or more rows for every rule: codes that are empty, NULL or invalid, amounts below zero or at and beyond the cap, a copy.
SAMPLE = [
    ("north-1", "pa", "north", "R10", 320.4, "PENDING"),
    ("north-2", "pb", "north", "K21", 74.15, "DENIED"),
    ("north-3", "pc", "north", "", 611.0, "APPROVED"),
    ("north-4", "pd", "north", "K21", -88.6, "APPROVED"),
    ("north-5", "pd", "north", "INVALID-CODE-999", 45.0, "DENIED"),
    ("quay-1", "pe", "quay", None, 19.99, "PENDING"),
    ("quay-2", "pf", "quay", "S52", 50_000.0, "APPROVED"),
    ("quay-3", "pg", "quay", "S52", -73_210.5, "APPROVED"),
    ("south-1", "ph", "south", "R10", 1204.5, "APPROVED"),
    ("south-1", "ph", "south", "R10", 1204.5, "APPROVED"),
    ("south-2", "pi", "south", "INVALID-CODE-999", -3.0, "PENDING"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        **{
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def claim_frame(spark):
    return lambda rows: spark.createDataFrame(rows, CLAIM_SCHEMA)


@pytest.fixture(scope="session")
def sample(claim_frame):
    return claim_frame(SAMPLE)
