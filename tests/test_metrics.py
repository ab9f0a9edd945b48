"""Metrics against brute-force Python definitions on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hourloom.operators import metrics as M


def _dcg_tie_avg(gain, pred, k):
    """Direct loop over the tie-averaged DCG definition."""
    blocks = {}
    for g, p in zip(gain, pred):
        blocks.setdefault(p, []).append(g)
    total, start = 0.0, 0
    for p in sorted(blocks, reverse=True):
        gs = blocks[p]
        n = len(gs)
        disc = sum(1.0 / math.log2(pos + 1) for pos in range(start + 1, min(start + n, k) + 1))
        total += (sum(gs) / n) * disc
        start += n
    return total


def _ndcg(gain, pred, k):
    ideal = sorted(gain, reverse=True)[:k]
    idcg = sum(g / math.log2(i + 2) for i, g in enumerate(ideal))
    return 0.0 if idcg == 0 else _dcg_tie_avg(gain, pred, k) / idcg


def test_ndcg_matches_brute_force(spark):
    rnd = random.Random(7)
    rows, groups = [], {}
    for gid in range(40):
        size = rnd.choice([1, 2, 3, 4, 7, 12])
        for _ in range(size):
            g = float(rnd.choice([0, 0, 1, 2, 3]))
            p = float(rnd.choice([0.1, 0.2, 0.2, 0.5, 0.9]))   # many ties
            rows.append((gid, g, p))
            groups.setdefault(gid, []).append((g, p))
    groups[99] = [(0.0, 0.3), (0.0, 0.1)]       # all-zero gain → 0
    groups[98] = [(3.0, 0.9), (2.0, 0.5), (1.0, 0.1)]  # perfect order → 1
    rows += [(99, g, p) for g, p in groups[99]] + [(98, g, p) for g, p in groups[98]]
    df = spark.createDataFrame(rows, "grp int, gain double, pred double")
    for k in (3, 5):
        per = {r.grp: r.ndcg for r in M.ndcg_at_k(df, ["grp"], "gain", "pred", k,
                                                  per_group=True).collect()}
        expect = {g: _ndcg([a for a, _ in v], [b for _, b in v], k)
                  for g, v in groups.items() if len(v) >= 2}
        assert per.keys() == expect.keys()              # groups of one are skipped
        for g, v in expect.items():
            assert per[g] == pytest.approx(v, abs=1e-12), (k, g)
        assert per[99] == 0.0 and per[98] == pytest.approx(1.0)
        mean = M.ndcg_at_k(df, ["grp"], "gain", "pred", k).first()[f"ndcg_at_{k}"]
        assert mean == pytest.approx(sum(expect.values()) / len(expect))


def test_regression_metrics(spark):
    y = [1.0, 2.0, 4.0, 8.0]
    p = [1.5, 1.5, 5.0, 6.0]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    mae = sum(abs(a - b) for a, b in zip(y, p)) / 4
    sse = sum((a - b) ** 2 for a, b in zip(y, p))
    mean = sum(y) / 4
    sst = sum((a - mean) ** 2 for a in y)
    assert r.mae == pytest.approx(mae) and r.rmse == pytest.approx(math.sqrt(sse / 4))
    assert r.r2 == pytest.approx(1 - sse / sst)


def test_hit_rate_candidates(spark):
    tasks = spark.createDataFrame([("t", 1, 7, 10.0), ("t", 2, 8, 10.0), ("solo", 3, 1, 1.0)],
                                  "con string, task_id int, actual int, v double")
    people = spark.createDataFrame(
        [("t", 7, 10.0), ("t", 8, 0.0), ("t", 9, 9.0), ("t", 5, 11.0), ("solo", 1, 1.0)],
        "con string, employee int, m double")
    score = -F.abs(F.col("m") - F.col("v"))
    r = M.hit_rate_candidates(tasks, people, "con", "task_id", "actual", "employee", score,
                              k=3).first()
    # tenant "solo" has one employee → skipped; task 1: top-3 = {7, 9, 5} → hit; task 2: miss
    assert (r.tasks, r.hits) == (2, 1) and r.hit_rate == 0.5


def test_hit_rate_in_group(spark):
    rows = [(i, "g", i % 4, float(i)) for i in range(10)] + [(100, "small", 1, 1.0)]
    df = spark.createDataFrame(rows, "id int, grp string, emp int, s double")
    sampled = df.where(F.col("id").isin(9, 0, 100))
    r = M.hit_rate_in_group(df, sampled, ["grp"], "id", "emp", "s", k=3).first()
    # top-3 rows of g: ids 9, 8, 7 → employees {1, 0, 3}; id 9 (emp 1) hit, id 0 (emp 0) hit;
    # group "small" has < 3 rows → skipped
    assert (r.tasks, r.hits) == (2, 2)


def test_group_split_keeps_groups_together(spark):
    rows = [(i, f"c{i % 13}", f"t{i % 5}") for i in range(2000)]
    df = M.group_split(spark.createDataFrame(rows, "id int, con string, task string"),
                       ["con", "task"])
    sides = df.groupBy("con", "task").agg(F.countDistinct("is_train").alias("n")).collect()
    assert all(r.n == 1 for r in sides)
    share = df.agg(F.avg(F.col("is_train").cast("double"))).first()[0]
    assert 0.55 < share < 0.95
    rs = M.row_split(df, "id").agg(F.avg(F.col("is_train").cast("double"))).first()[0]
    assert rs == pytest.approx(0.8, abs=0.03)
