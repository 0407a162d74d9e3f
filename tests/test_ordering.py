import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.operators.ordering import exact_quantile, position_key, running_total, top


def test_running_total_equals_plain_loop_with_a_hot_value(spark):
    """A third of all rows share one value; ties are ordered by id."""
    dice = random.Random(3)
    rows = [(i, 5 if i % 3 == 0 else dice.randint(0, 100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v long").repartition(7)
    got = running_total(df, [F.desc("v"), F.asc("id")], F.col("v"), "run").orderBy(F.desc("v"), "id").collect()
    total, expected = 0, []
    for i, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += v
        expected.append((i, v, total))
    assert [(r["id"], r["v"], r["run"]) for r in got] == expected
    assert {r["run_total"] for r in got} == {total}


def test_position_key_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "vendor_id").repartition(5)
    got = position_key(df, [F.col("vendor_id")], "n").collect()
    assert sorted((r["vendor_id"], r["n"]) for r in got) == [(v, i + 1) for i, v in enumerate(range(0, 5000, 3))]


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0] * 50 + [1.0, 2.0, 8.0, 9.5], list(map(float, range(101)))])
def test_exact_quantile_is_the_linear_one(spark, q, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert exact_quantile(df, "v", q) == pytest.approx(np.quantile(values, q), abs=1e-12)


def test_exact_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


def test_top_uses_no_full_sort(spark):
    df = top(spark.range(1000), 5, F.desc("id"))
    assert [r["id"] for r in df.collect()] == [999, 998, 997, 996, 995]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
