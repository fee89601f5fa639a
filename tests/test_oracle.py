"""Every query of the catalogue against its SQL twin."""

import pytest

import __spark_entry__ as contract
import check

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.database(SMALL)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    assert check.compare(spark, con, SMALL, name) == ""


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() == 5740
    assert {"is_anomaly", "anomaly_confidence", "risk_level"} <= set(df.columns)
