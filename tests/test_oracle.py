"""Every registered query with SQL gives the rows DuckDB gives."""

import comparing
import pytest

from duecast.plans import model_queries
from duecast.plans.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return comparing.duck(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, small, name, monkeypatch):
    if name == "train_status":
        # The registered query searches the full grid, see test_models; its status does not depend on it.
        monkeypatch.setattr(model_queries.forest, "Grid", lambda: model_queries.QUICK_GRID)
    assert comparing.differences(QUERIES[name](spark, small), con, ORACLE[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
