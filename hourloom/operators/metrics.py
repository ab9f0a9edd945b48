"""Splits, labels and evaluation metrics (M1-M3, M10-M12b, M14, M17) as SQL-expressible jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.columns import right_closed_bin
from hourloom.operators.relational import bounded_broadcast, top_candidates

# Relevance label edges for the 0..1 suitability score (5 right-closed bins) and
# duration bands (hours) of the error breakdown.
RANK_LABEL_EDGES = [-0.001, 0.2, 0.4, 0.6, 0.8, 1.001]
DURATION_BANDS = [0, 1, 3, 8, float("inf")]


def split_bucket(key: Column) -> Column:
    """Deterministic 0..99 bucket of a key — independent of partitioning (``randomSplit`` is not) and of
    how ids are dealt out: the first 16 bits of the MD5 of its text, mod 100, as for groups (M2)."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("int"), F.lit(100))


def row_split(df: DataFrame, key: str, train_pct: int = 80, out: str = "is_train") -> DataFrame:
    """M1: 80/20 split on the unique row key."""
    return df.withColumn(out, split_bucket(F.col(key)) < train_pct)


def group_bucket(group_cols: Sequence[str]) -> Column:
    """0..99 bucket of a composite group key: the first 16 bits of the MD5 of ``a__b`` mod 100
    (a fixed public hash, so other engines reproduce the same split)."""
    return split_bucket(F.concat_ws("__", *[F.col(c).cast("string") for c in group_cols]))


def group_split(df: DataFrame, group_cols: Sequence[str], train_pct: int = 80,
                out: str = "is_train") -> DataFrame:
    """M2: 80/20 split on group keys — every row of a group lands on the same side, decided per
    row from the key alone, so no group list is collected or joined."""
    return df.withColumn(out, group_bucket(group_cols) < train_pct)


def relevance_label(score: str, out: str = "rank_label") -> Column:
    """M3: score → 0..4 right-closed bins (R14: on the double value)."""
    return right_closed_bin(F.col(score).cast("double"), RANK_LABEL_EDGES).alias(out)


def regression_metrics(df: DataFrame, label: str, pred: str, keys: Sequence[str] = ()
                       ) -> DataFrame:
    """MAE, RMSE and R² = 1 − SSE/SST in one aggregate (SST = population variance · n, a
    numerically stable one-pass moment)."""
    e = F.col(pred).cast("double") - F.col(label).cast("double")
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.sum(e * e) / F.nullif(F.var_pop(F.col(label)) * F.count(F.col(label)),
                                              F.lit(0.0))).alias("r2"))


def ndcg_at_k(df: DataFrame, group: Sequence[str], gain: str, pred: str, k: int | Sequence[int],
              per_group: bool = False) -> DataFrame:
    """NDCG@k per group with tie-averaged DCG, mean/std over groups of ≥ 2 rows.

    Rows with equal predictions form a block; a block starting after ``st`` earlier rows adds
    ``avg(gain) · Σ_{p=st+1}^{min(st+n,k)} 1/log2(p+1)``. IDCG sorts by gain. IDCG 0 → 0.
    Only the first ``k`` blocks and the first ``k`` gains of a group matter, so both sides are
    top-k windows (Spark plans a WindowGroupLimit before the shuffle: a huge group sends at most
    k rows per task), never a full sort of a group. Several cut-offs (``k`` a list) share one
    block aggregation and one ideal ranking, computed for the largest k.
    """
    ks = [k] if isinstance(k, int) else list(k)
    kmax = max(ks)
    g = list(group)
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("__size"))
    blocks = df.groupBy(*g, pred).agg(F.count(F.lit(1)).alias("__n"),
                                      F.avg(F.col(gain).cast("double")).alias("__g"))
    wb = Window.partitionBy(*g).orderBy(F.col(pred).desc())
    blocks = blocks.withColumn("__bi", F.row_number().over(wb)).where(F.col("__bi") <= kmax)
    blocks = blocks.withColumn("__st", F.coalesce(F.sum("__n").over(
        wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def disc(kk):
        return F.aggregate(F.sequence(F.col("__st") + 1, F.least(F.col("__st") + F.col("__n"),
                                                                  F.lit(kk))),
                           F.lit(0.0), lambda a, p: a + F.lit(1.0) / F.log2(p + F.lit(1.0)))

    dcg = blocks.groupBy(*g).agg(*[
        F.sum(F.when(F.col("__st") < kk, F.col("__g") * disc(kk)).otherwise(F.lit(0.0)))
        .alias(f"__dcg{kk}") for kk in ks])
    wi = Window.partitionBy(*g).orderBy(F.col(gain).desc())
    ideal = df.select(*g, gain).withColumn("__r", F.row_number().over(wi))\
        .where(F.col("__r") <= kmax)
    ig = F.col(gain).cast("double") / F.log2(F.col("__r") + F.lit(1.0))
    idcg = ideal.groupBy(*g).agg(*[F.sum(F.when(F.col("__r") <= kk, ig).otherwise(F.lit(0.0)))
                                   .alias(f"__idcg{kk}") for kk in ks])
    per = sizes.where(F.col("__size") >= 2).join(dcg, g, "left").join(idcg, g, "left")
    per = per.withColumns({f"ndcg_{kk}": F.when(F.col(f"__idcg{kk}") > 0,
                                                 F.col(f"__dcg{kk}") / F.col(f"__idcg{kk}"))
                           .otherwise(F.lit(0.0)) for kk in ks})
    if per_group:
        out = per.select(*g, *[f"ndcg_{kk}" for kk in ks])
        return out.withColumnRenamed(f"ndcg_{ks[0]}", "ndcg") if isinstance(k, int) else out
    aggs = [F.count(F.lit(1)).cast("long").alias("groups")]
    for kk in ks:
        aggs += [F.avg(f"ndcg_{kk}").alias(f"ndcg_at_{kk}"),
                 F.stddev_pop(f"ndcg_{kk}").alias(f"ndcg_std_{kk}")]
    return per.agg(*aggs)


def hit_rate_candidates(sampled: DataFrame, people: DataFrame, tenant: str, task_id: str,
                        actual: str, person: str, score: Column, k: int = 3) -> DataFrame:
    """Top-k hit rate. ``people`` has one row per (tenant, person) with any person
    features the score needs. For each sampled task, every person of its tenant is a candidate
    (J15, tenants with < 2 people skipped), candidates are scored with ``score`` (a Column over
    the task and person columns), the top-k (ties by person id) are kept, and a hit is the
    actual person being among them. Returns (tasks, hits, hit_rate).

    Both sides may be large: pairs meet in cells of bounded size that keep their own top-k."""
    ppl = people
    n_ppl = ppl.groupBy(tenant).agg(F.count(F.lit(1)).alias("__np"))
    tasks = sampled.join(bounded_broadcast(n_ppl), tenant).where(F.col("__np") >= 2)
    top = top_candidates(tasks, ppl, tenant, task_id, person, score, k)
    hits = top.where(F.col(person) == F.col(actual)).select(task_id).distinct()\
        .withColumn("__hit", F.lit(1))
    per = tasks.select(task_id).join(hits, task_id, "left")
    return per.agg(F.count(F.lit(1)).cast("long").alias("tasks"),
                   F.count("__hit").cast("long").alias("hits"),
                   (F.count("__hit") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("hit_rate"))


def hit_rate_in_group(df: DataFrame, sampled: DataFrame, group: Sequence[str], row_id: str,
                      person: str, score: str, k: int = 3) -> DataFrame:
    """Hit rate ranking the existing rows of the sampled row's own group by their score;
    groups with < k rows are skipped. The group ranking does not depend on which row was
    sampled, so the top-k per group is computed once (WindowGroupLimit) and each sampled row
    only checks membership — no row pairs."""
    g = list(group)
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("__size"))
    w = Window.partitionBy(*g).orderBy(F.col(score).desc(), F.col(row_id))
    top = df.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= k)\
        .select(*g, F.col(person).alias("__tp")).distinct()
    s = sampled.select(*g, row_id, person).join(sizes, g).where(F.col("__size") >= k)
    j = s.join(top.withColumnRenamed("__tp", person).withColumn("__hit", F.lit(1)),
               [*g, person], "left")
    return j.agg(F.count(F.lit(1)).cast("long").alias("tasks"),
                 F.count("__hit").cast("long").alias("hits"),
                 (F.count("__hit") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("hit_rate"))


def error_breakdown(df: DataFrame, label: str, pred: str, by: str, min_rows: int = 1
                    ) -> DataFrame:
    """MAE, RMSE, mean residual (prediction − label), row count and mean label per group,
    groups with ≥ ``min_rows``."""
    e = F.col(pred) - F.col(label)
    return df.groupBy(by).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e).alias("mean_residual"), F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(label).alias("mean_label"))\
        .where(F.col("n") >= min_rows)


def duration_band(col: str) -> Column:
    """Right-closed duration band index over ``DURATION_BANDS``."""
    return right_closed_bin(F.col(col), DURATION_BANDS)


def champion_gate(history: DataFrame, candidate: DataFrame, model_col: str = "model",
                  metric: str = "time_mae") -> DataFrame:
    """A candidate run is registered only if its metric beats (is below) the best stored
    metric of the same model; no history → registered. Returns the candidate rows with
    ``best_before`` and ``register``."""
    best = history.groupBy(model_col).agg(F.min(metric).alias("best_before"))
    j = candidate.join(best, model_col, "left")
    return j.withColumn("register", F.col("best_before").isNull()
                        | (F.col(metric) < F.col("best_before")))


def duration_band_of(x: Column) -> Column:
    """Right-closed band index of an expression over ``DURATION_BANDS``."""
    return right_closed_bin(x, DURATION_BANDS)
