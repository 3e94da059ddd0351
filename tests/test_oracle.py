import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from compare import connect, difference  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
