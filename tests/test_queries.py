"""Every registered query against its SQL counterpart on the given tables."""

import pytest

from ledgerlark.plans.catalog import QUERIES
from ledgerlark.plans.oracle import ORACLE
from tests.conftest import SMALL
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SMALL, name) is None


def test_entry(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.count() > 0
    assert result.columns == [
        "country_region", "calendar_year", "channel_desc", "amount_sold",
        "% BY CHANNELS", "% PREVIOUS PERIOD", "% DIFF",
    ]


def test_results_hold_no_type_that_engines_show_differently(spark):
    for name in ("share_lag", "post_sales_lines", "scalar_date"):
        kinds = {kind for _, kind in QUERIES[name](spark, SMALL).dtypes}
        assert not any(kind.startswith(("decimal", "date", "timestamp")) for kind in kinds)
