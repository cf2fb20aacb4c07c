"""Queries that SQL can express equal their oracles."""

import pytest

from fieldmill.llm.oracle import LLM_ORACLE
from fieldmill.llm.queries import LLM_QUERIES
from workload.compare import _bag, connect


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_equals_oracle(spark, sf_dir, name):
    df = LLM_QUERIES[name](spark, sf_dir)
    result = connect(sf_dir).execute(LLM_ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(names, result.fetchall())
