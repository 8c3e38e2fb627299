"""Every registered query against its SQL; queries without SQL return rows."""

import pytest

from barkline import catalogue

from oracle import assert_equal


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    if name in catalogue.ORACLE_SQL:
        assert_equal(df, sf_dir, catalogue.ORACLE_SQL[name])
    else:
        assert df.count() > 0
