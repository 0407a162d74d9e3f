"""Every registered text query against DuckDB where SQL can express it; plans of the native ones."""

import pytest

from checks.compare import compare, open_duckdb
from martwright.llm.oracle import ORACLE
from martwright.llm.queries import QUERIES


def test_one_query_per_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_duckdb(spark, folder, name):
    verdict, _, _ = compare(spark, open_duckdb(folder), QUERIES[name], ORACLE[name], folder)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", ["op4_quality_ledger", "op8_source_mix"])
def test_native_plans_have_no_python(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for word in ["Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert word not in plan


def test_entry_has_all(spark):
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())
