"""Every query of the folder that SQL can express against its SQL, and the registration."""

import oracle
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
import corpus_pipeline
from creditloom.llm import queries


def test_all_thirteen_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in names) != 1] == []
    assert names["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in entry_points.oracle_sql()
    assert set(queries.statements()) <= set(queries.callables())


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(spark, name):
    frame = queries.callables()[name](spark, SMALL)
    assert oracle.differences(frame, oracle.connect(SMALL), queries.statements()[name]) == []
