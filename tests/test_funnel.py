"""Q18: totals along the tree of counts equal the joins themselves, for chains of all kinds."""

import random

import pytest
from pyspark.sql import functions as F

from hourloom.operators import quality as Q


def joined(base, steps):
    """Rows after each step by joining row by row; a left step counts the rows that found a match."""
    df, totals = base, [base.count()]
    for i, st in enumerate(steps):
        left, right = Q._names(st.left_keys), Q._names(st.right_keys)
        d = st.dim.na.drop(subset=right).select(*[F.col(k).alias(f"k{i}_{j}") for j, k in enumerate(right)],
                                                *[F.col(c).alias(f"c{i}_{c}") for c in st.carry], F.lit(1).alias(f"hit{i}"))
        on = [F.col(a) == F.col(f"k{i}_{j}") for j, a in enumerate(left)]
        df = df.join(d, on, st.how)
        df = df.drop(*[c for c in st.carry if c in df.columns]).withColumnsRenamed({f"c{i}_{c}": c for c in st.carry})
        totals.append(df.where(F.col(f"hit{i}") == 1).count())
    return totals


@pytest.mark.parametrize("seed", range(2))
def test_totals_equal_the_joins(spark, seed):
    rng = random.Random(seed)

    def key():
        return rng.choice([None, *range(8)])
    base = spark.createDataFrame([(key(), key(), key()) for _ in range(60)], "a int, b int, c int")
    dims = [spark.createDataFrame([(key(), key(), key()) for _ in range(14)], "p int, q int, r int") for _ in range(5)]
    how = [rng.choice(["inner", "left"]) for _ in range(5)]
    steps = [Q.FunnelStep("one", dims[0].withColumnsRenamed({"q": "q1", "r": "r1"}), "a", "p", ["q1", "r1"], how[0]),
             Q.FunnelStep("two", dims[1].withColumnsRenamed({"q": "q2", "r": "r2"}), "q1", "p", ["q2"], how[1]),
             Q.FunnelStep("three", dims[2].withColumnsRenamed({"q": "q3", "r": "r3"}), ["b", "c"], ["p", "q3"], ["r3"], how[2]),
             Q.FunnelStep("four", dims[3], "q2", "p", [], how[3]),
             Q.FunnelStep("five", dims[4].withColumnsRenamed({"q": "r1"}), "r1", "p", ["r1"], how[4])]
    assert all(len(o) == 1 for o in Q._owners(steps))
    want = joined(base, steps)
    assert Q._totals_by_counts(base, steps).first().totals == want
    assert Q._totals_by_step(base, steps).first().totals == want
    mixed = [*steps[:3], Q.FunnelStep("mixed", dims[3], ["a", "q1"], ["p", "q"], [], how[3])]
    assert [r.rows for r in Q.join_funnel(base, "base", mixed).orderBy("step").collect()] == joined(base, mixed)


def test_the_base_is_read_once_and_nothing_is_written(spark, monkeypatch):
    from hourloom import session
    monkeypatch.setattr(session, "materialize", lambda df: pytest.fail("a table was written"))
    from hourloom.plans.catalog.quality import q18_join_funnel
    plan = q18_join_funnel(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("customer.parquet") == 1


def test_an_empty_base(spark):
    none = spark.createDataFrame([], "a int")
    dim = spark.createDataFrame([(1,)], "p int")
    report = Q.join_funnel(none, "base", [Q.FunnelStep("one", dim, "a", "p")]).orderBy("step").collect()
    assert [(r.step_name, r.rows, r.light) for r in report] == [("base", 0, "green"), ("one", 0, "green")]
