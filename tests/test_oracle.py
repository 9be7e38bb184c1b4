"""Every registered query with an oracle matches DuckDB on the smallest scale."""
import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
_SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(_SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    odf = con.execute(_SQL[name]).fetchdf()
    assert compare(sdf, odf) is None


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "margin" in df.columns
