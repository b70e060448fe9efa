"""Every query with an SQL equivalent gives the same rows as DuckDB."""

import pytest

from checks.compare import differences, duckdb_views
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import SMALL

WITHOUT_SQL = {"train_logistic", "train_boosted", "model_fraud_scores", "feature_importance", "boosted_forest"}


@pytest.fixture(scope="module")
def connection():
    return duckdb_views(SMALL)


def test_every_query_is_covered():
    assert set(QUERIES) == set(ORACLE) | WITHOUT_SQL


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, ORACLE[name]) == ""
