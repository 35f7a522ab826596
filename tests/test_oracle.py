"""Every named query against its SQL, and the known totals of the test tables."""

from decimal import Decimal

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loanlens.sources.statements import latest_statements, statements
from loanlens.streaming.alerts import high_risk

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    result = entry.queries()[name](spark, SF)
    assert difference(result, connection, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_other_queries_give_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_known_totals(spark):
    folder = "/root/testdata/sf0.01"
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    everything = statements(spark, folder)
    assert total(everything, "original_principal_amount") == Decimal("1497117216446.00")
    assert total(everything, "cancelled_amount") == Decimal("100925736862.68")
    latest = latest_statements(spark, folder)
    assert latest.count() == 14743
    assert total(latest, "cancelled_amount") == Decimal("24730316180.84")
    levels = high_risk(latest).groupBy("risk_level").count().collect()
    assert {r.risk_level: r["count"] for r in levels} == {
        "CRITICAL": 764,
        "HIGH": 1229,
        "ELEVATED": 2001,
    }
