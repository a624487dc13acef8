"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import pytest
from compare import mismatch, oracle_connection
from conftest import SF

from tidemark.operators import models
from tidemark.registry.oracles import ORACLES
from tidemark.registry.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name, monkeypatch):
    # The searches and fits of all other tests are small; here the registered ones run with fewer points and rounds.
    monkeypatch.setitem(models.GRIDS, "random_forest", {"n_estimators": [5, 10], "max_depth": [2, 4], "min_samples_split": [10, 20]})
    monkeypatch.setitem(models.FROZEN, "gradient_boosting", {**models.FROZEN["gradient_boosting"], "n_estimators": 10})
    df = QUERIES[name](spark, SF)
    if name not in ORACLES:
        assert df.count() > 0
        return
    assert mismatch(df, con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
