"""The candidate grid against a plain double loop, and its plan on a tenant large on both sides."""

import random

import pytest
from pyspark.sql import functions as F

from hourloom.operators.relational import candidate_cells, expand_candidates, top_candidates

def closeness():
    return -F.abs(F.col("level") - F.col("want"))


def sides(spark, n_tasks, n_people, seed=1):
    rnd = random.Random(seed)
    tasks = [(rnd.choice(["a", "a", "a", "b", None]), i, rnd.choice([None, *range(20)])) for i in range(n_tasks)]
    people = [(rnd.choice(["a", "a", "a", "b", "c"]), i, float(rnd.randrange(20))) for i in range(n_people)]
    return tasks, people, (spark.createDataFrame(tasks, "tenant string, task long, want int"),
                           spark.createDataFrame(people, "tenant string, person long, level double"))


@pytest.mark.parametrize("cells", [(7, 5), (1, 1), (1000, 1000)])
def test_top_candidates_equals_a_double_loop(spark, cells):
    tasks, people, (t, p) = sides(spark, 60, 45)
    got = {(r.task, r["rank"]): (r.person, r.score) for r in top_candidates(
        t, p, "tenant", "task", "person", closeness(), 3, *cells).collect()}
    want = {}
    for tenant, task, level in tasks:
        mine = [(None if level is None else -abs(x - level), person) for other, person, x in people if other == tenant]
        mine.sort(key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        want.update({(task, i): (person, score) for i, (score, person) in enumerate(mine[:3], 1)})
    assert got == want


def test_every_pair_meets_once(spark):
    tasks, people, (t, p) = sides(spark, 50, 40)
    got = sorted((r.task, r.person) for r in candidate_cells(t, p, "tenant", 6, 4).collect())
    assert got == sorted((a[1], b[1]) for a in tasks for b in people if a[0] is not None and a[0] == b[0])
    assert expand_candidates(t, p, "tenant").count() == len(got)
    assert expand_candidates(t.limit(0), p, "tenant").count() == 0 and expand_candidates(t, p.limit(0), "tenant").count() == 0


def test_large_sides_meet_without_broadcast_or_hot_key(spark):
    tenant = F.when(F.col("id") % 50_000 == 0, "b").otherwise("a").alias("tenant")
    t = spark.range(100_000).select(tenant, F.col("id").alias("task"), F.col("id").alias("want"))
    p = spark.range(100_000).select(tenant, F.col("id").alias("person"), F.col("id").alias("level"))
    pairs = candidate_cells(t, p, "tenant")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = candidate_cells(t, p, "tenant")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin [tenant" in plan and "hashpartitioning(tenant" in plan and "__row" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    # the sides as they are dealt: 98 x 98 cells, each with about 1024 tasks and people
    dealt = t.withColumn("cell", F.pmod(F.xxhash64("tenant", "task", "want"), F.lit(98))).groupBy("cell").count()
    assert dealt.agg(F.max("count")).first()[0] < 1300
    assert {"__row", "__col"} <= set(pairs.columns)
