"""The text queries that SQL can state, against that SQL, and what the entry registers."""

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from compare import connect, differences
from skyledger.llm import queries


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, sf_dir, key):
    assert differences(queries.QUERIES[key](spark, sf_dir), connect(sf_dir),
                       queries.ORACLE_SQL[key]) == []


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES
                     if name != "quality_ablations")
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
