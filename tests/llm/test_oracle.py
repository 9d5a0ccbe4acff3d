import pytest

from parlance.llm.oracle import ORACLE
from parlance.llm.queries import QUERIES
from tests.compare import same


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, name):
    same(spark, QUERIES[name], ORACLE[name])


def test_all_problems_have_queries():
    assert {int(q[1:].split("_")[0]) for q in QUERIES} == {2, 3, 4, 5, 6, 7, 8, 9, 10}
    assert set(ORACLE) <= set(QUERIES)
