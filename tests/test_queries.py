"""Every batch query against its SQL, with segments small enough to matter."""

import pytest

import __spark_entry__ as contract
from quotelane.operators.scan import SEGMENT_SETTING
from quotelane.plans.catalog import BATCH
from quotelane.plans.streams import STREAMS
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.fixture(autouse=True)
def small_segments(spark):
    spark.conf.set(SEGMENT_SETTING, "32")
    yield
    spark.conf.unset(SEGMENT_SETTING)


@pytest.mark.parametrize("name", list(BATCH))
def test_query_equals_sql(spark, sql, name):
    ours = contract.queries()[name](spark, SF).toPandas()
    theirs = sql.execute(contract.oracle_sql()[name]).df()
    assert len(ours) > 0
    assert difference(ours, theirs) is None


def test_every_query_has_sql():
    own = {**BATCH, **STREAMS}
    assert set(own) <= set(contract.queries())
    assert set(own) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
