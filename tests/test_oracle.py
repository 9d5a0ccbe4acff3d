import pytest

from parlance.plans.oracle import ORACLE
from parlance.plans.queries import QUERIES
from tests.compare import same


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, name):
    same(spark, QUERIES[name], ORACLE[name])
