import pytest
from skyledger import plans

from tests.oracle import SF, same


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    df = plans.QUERIES[name](spark, SF)
    if name in plans.ORACLES:
        same(df, plans.ORACLES[name])
    else:
        assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
