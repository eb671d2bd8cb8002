import pytest

from heronlake.llm.queries import QUERIES, SQL
from tests.compare import SMALL, connect, sides


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    ours, theirs = sides(QUERIES[name](spark, SMALL), connect(), SQL[name])
    assert ours == theirs
