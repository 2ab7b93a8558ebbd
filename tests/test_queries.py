"""Every registered query against its SQL twin."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, folder, duck, name):
    assert differences(queries()[name](spark, folder), duck, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_gives_rows(spark, folder, name):
    assert queries()[name](spark, folder).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = {r["attack_type"]: r["cnt"] for r in entry(spark).collect()}
    assert rows == {
        "DoS Hulk": 144, "DDoS": 118, "Infiltration": 64, "PortScan": 42, "Brute Force": 22, "Bot": 14,
        "Web Attack - XSS": 10,
    }
