"""Running sums over groups that are split across tasks."""

import pytest
from pyspark.sql import functions as F

from duecast.operators.positions import positions, running_sums


@pytest.fixture(scope="module")
def rows(spark):
    # One group holds most rows.
    return spark.range(3000).selectExpr("IF(id % 10 < 7, 0, id % 5) AS g", "(id * 7919) % 3001 AS o", "id % 4 AS v").cache()


@pytest.mark.parametrize("hot_rows", [50, 700, 10_000])
def test_running_sums_match_a_window(rows, hot_rows):
    got = running_sums(rows, ["g"], [F.col("o").desc()], {"s": F.col("v")}, hot_rows)
    by_group = {}
    for r in sorted(rows.collect(), key=lambda r: -r["o"]):
        by_group[r["g"]] = by_group.get(r["g"], 0) + r["v"]
        by_group[(r["g"], r["o"])] = by_group[r["g"]]
    assert all(by_group[(r["g"], r["o"])] == r["s"] for r in got.collect())
    assert got.count() == rows.count()


def test_positions_count_from_zero(rows):
    got = positions(rows, ["g"], [F.col("o")], "p", 50)
    spans = got.groupBy("g").agg(F.min("p"), F.max("p"), F.countDistinct("p"), F.count("*")).collect()
    assert all(r[1] == 0 and r[2] == r[4] - 1 and r[3] == r[4] for r in spans)


def test_no_task_sees_a_hot_group_whole(rows):
    from duecast.operators.positions import sliced_running_sums

    hot = rows.where("g = 0")
    got = sliced_running_sums(hot, ["g"], [F.col("o")], {"p": F.lit(1)}, 8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "hashpartitioning(g#" not in plan.split("AdaptiveSparkPlan")[0]
    assert got.count() == hot.count()
