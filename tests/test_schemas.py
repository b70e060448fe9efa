from collections import Counter

from cardwarden import schemas
from cardwarden.operators.base_view import base_view
from cardwarden.operators.requests import REQUEST_FIELDS
from cardwarden.schemas import FEATURE_TABLE_COLUMNS, KEY


def test_declared_columns():
    kinds = Counter(f.dataType.simpleString() for f in schemas.TRANSACTIONS)
    assert kinds == {"double": 376, "string": 14, "bigint": 4}
    kinds = Counter(f.dataType.simpleString() for f in schemas.IDENTITY)
    assert kinds == {"double": 23, "string": 17, "bigint": 1}
    assert len(schemas.STREAM_TABLE) == 22
    assert len(REQUEST_FIELDS) == 26
    for schema in (schemas.TRANSACTIONS, schemas.IDENTITY, schemas.STREAM_TABLE):
        assert [f.name for f in schema if not f.nullable] == [KEY]


def test_feature_lists():
    assert len(schemas.LOGISTIC_FEATURES) == 37
    assert len(schemas.BOOSTED_FEATURES) == 36
    assert len(set(FEATURE_TABLE_COLUMNS)) == 40


def test_view_has_85_columns(spark):
    view = base_view(
        spark.createDataFrame([], schemas.TRANSACTIONS), spark.createDataFrame([], schemas.IDENTITY)
    )
    assert len(view.columns) == len(set(view.columns)) == 85
