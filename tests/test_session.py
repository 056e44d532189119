"""Fits of many short jobs: few tasks per job, independent fits at a time."""

import threading

import pytest
from pyspark.sql import functions as F

from keepcurve.operators import boosting as bo
from keepcurve.session import few_tasks, together


def test_few_tasks_keeps_rows_and_fills_tasks(spark):
    df = spark.range(0, 1000, 1, 50)
    assert few_tasks(df, 400).rdd.getNumPartitions() == 3 and few_tasks(df, 400).count() == 1000
    assert few_tasks(df.where("id < 0"), 400).count() == 0


def test_steps_run_at_the_same_time_and_errors_are_raised(spark):
    meet = threading.Barrier(2)

    def step(n):
        meet.wait(60)
        return spark.range(n).count()

    assert together(lambda: step(3), lambda: step(5)) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        together(lambda: 1, lambda: 1 // 0)


def test_levels_of_a_small_table_are_one_task_without_a_shuffle(spark, monkeypatch):
    seen, level = [], bo._level_job
    monkeypatch.setattr(bo, "_level_job", lambda rows, *a: seen.append(rows.rdd.getNumPartitions()) or level(rows, *a))
    df = spark.range(0, 400, 1, 40).select(F.col("id").alias("key"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3 == 0).cast("double").alias("y"))
    bo.fit_boosted(df, ["a"], "y", "key", valid=df, params=bo.BoostParams(trees=2, depth=2))
    assert seen and set(seen) == {1}
