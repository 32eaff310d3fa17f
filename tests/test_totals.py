import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from newsflow.operators import totals
from newsflow.operators.totals import exact_percentiles, running_total


def test_running_total_over_a_hot_group_of_copies(spark):
    rng = random.Random(3)
    # One group holds most rows, a third of all rows are equal in every column.
    rows = [("hot", 5, 7)] * 1000 + [("hot", rng.randrange(20), rng.randrange(1, 9)) for _ in range(1200)]
    rows += [(f"g{rng.randrange(5)}", rng.randrange(20), rng.randrange(1, 9)) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, k int, v bigint").repartition(5)
    found = running_total(df, ["g"], ["k"], "v", "before", total="all", slices=7).collect()
    assert len(found) == len(rows)
    for group in {r[0] for r in rows}:
        members = sorted((r for r in found if r.g == group), key=lambda r: r.before)
        position = 0
        for r in members:
            assert r.before == position
            position += r.v
        assert [r.k for r in members] == sorted(r.k for r in members)
        assert {r["all"] for r in members} == {position}


def test_hot_group_spans_many_slices(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.lit(1).alias("k"), F.lit(1).alias("v"))
    found = running_total(df, ["g"], ["k"], "v", "before", slices=8)
    assert found.agg(F.count_distinct("before"), F.max("before")).first()[:] == (4000, 3999)
    # The rows were shuffled once, when they were stored; what is left is a join of a few slice starts.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "rightHint=(strategy=broadcast)" in plan


def test_many_slice_starts_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(totals, "BROADCAST_STARTS", 3)
    df = spark.range(500).selectExpr("id % 7 AS g", "id AS k", "1 AS v")
    found = running_total(df, ["g"], ["k"], "v", "before", slices=5)
    assert "rightHint" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.g, r.before) for r in found.collect()} == {(k % 7, k // 7) for k in range(500)}


def test_percentiles(spark):
    rng = random.Random(5)
    values = {None: [7.0, 1.0, 1.0], "a": [rng.choice([1.5, 2.0, rng.random() * 9]) for _ in range(501)], "b": [4.0], "c": [1.0, 2.0]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99, "top": 1.0}, slices=3, mean="mean", maximum="most")
    rows = {r.g: r for r in found.collect()}
    for group, members in values.items():
        r = rows[group]
        assert r.n == len(members) and np.isclose(r.p50, statistics.median(members))
        assert np.isclose(r.p99, np.percentile(members, 99)) and r.top == r.most == max(members)
        assert np.isclose(r["mean"], np.mean(members))


def test_groups_without_values(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("b", None), (None, None), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99}, slices=3, mean="mean", maximum="most")
    got = {r.g: (r.n, r.p50, r.mean, r.most) for r in found.collect()}
    assert got == {"a": (2, 2.0, 2.0, 3.0), "b": (0, None, None, None), None: (1, 2.0, 2.0, 2.0)}
    assert exact_percentiles(df.where("false"), ["g"], "v", {"p50": 0.5}).collect() == []
