import pytest

from quernstone.plans.queries import ORACLES, QUERIES
from tests.compare import duck, same
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    same(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["chunk_id", "document_id", "clean_text"]
    assert set(e.oracle_sql()) <= set(e.queries())
