"""Every query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import compare, database
from conftest import SF_DIR

import __spark_entry__ as e
from gaugeflow.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    result, _ = compare(spark, con, SF_DIR, name, e.queries()[name], e.oracle_sql()[name])
    assert result.startswith("ok"), result
    assert result != "ok (0)"


def test_entry_has_rows(spark):
    df = e.entry(spark)
    assert df.columns == ["sid", "horizon", "change_class", "n", "mae", "scaled_mae"]
    assert df.count() == 5 * 6 * 5


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"gbt_fit", "batch_forecast"}
