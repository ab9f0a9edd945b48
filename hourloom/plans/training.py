"""Merge of both systems and the training flow, composed from operators.

The training flow returns DataFrames and fitted models; nothing is collected except bounded
model metadata (parameters, tenant list, importances)."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.columns import composite_key, fill_unknown, lenient_double
from hourloom.operators import encode as E
from hourloom.operators import metrics as M
from hourloom.operators import models as ML
from hourloom.operators.relational import expand_candidates, hash_sample
from hourloom.operators.score import canonical_merge, suitability_score

TARGET_TIME = "REAL_WORKED_TIME"
TARGET_RANK = "suitability_score"
GROUP_COLS = ["con", "BEWERKING_ID"]


def merge(system_a: DataFrame, system_b: DataFrame) -> DataFrame:
    """X10 + X5: canonical union of both systems, then the suitability score per tenant."""
    return suitability_score(canonical_merge(system_a, system_b))


def prepare_training_frame(df: DataFrame) -> DataFrame:
    """Categorical NULL → 'ONBEKEND' (as strings), numeric lenient cast, NULL → 0."""
    d = df
    for c in E.NUMERICAL + [TARGET_TIME, TARGET_RANK]:
        if c in d.columns:
            d = d.withColumn(c, lenient_double(c))
    d = fill_unknown(d, [c for c in E.CATEGORICAL if c in d.columns],
                     [c for c in E.NUMERICAL if c in d.columns])
    return d.where(F.col(TARGET_TIME).isNotNull())


@dataclass
class TrainResult:
    regressor: ML.TenantModels
    ranker: ML.TenantModels
    dictionary: DataFrame
    metrics: DataFrame
    features: list[str]
    registered: bool = True


def best_duration_params(train_rows: DataFrame, feats: list[str], stored: DataFrame | None, model: str,
                         grid: dict | None) -> dict:
    """M9: parameters of the best stored run of ``model``, else the grid point of least validation
    MAE, else none."""
    known = ML.cached_best_params(stored, model)
    if known or not grid:
        return known or {}
    pipe = ML.boosted_trees(feats, TARGET_TIME, max_iter=10)

    def points(est, builder):
        for name, values in grid.items():
            builder = builder.addGrid(est.getParam(name), values)
        return builder

    return ML.tune(pipe, points, train_rows, TARGET_TIME)[1]


def best_ranker_params(g: DataFrame, feats: list[str], stored: DataFrame | None, model: str,
                       depths: list[int]) -> dict:
    """M9: as above for the ranker, chosen by NDCG@3 on a fifth of the training groups."""
    known = ML.cached_best_params(stored, model, metric="neg_ndcg_at_3")
    if known or not depths:
        return known or {}
    # another split than the outer one: on the reversed key
    inner = g.withColumn("__inner", F.reverse("_group_key"))
    inner = M.group_split(inner, ["__inner"], out="inner_train")
    if inner.select("inner_train").distinct().count() < 2:   # too few groups to hold any out
        return {}
    scored = {}
    for depth in depths:
        m = ML.random_forest(feats, TARGET_RANK, num_trees=20, max_depth=depth).fit(inner.where("inner_train"))
        nd = M.ndcg_at_k(m.transform(inner.where("not inner_train")), ["_group_key"], TARGET_RANK, "prediction", [3])
        scored[depth] = nd.first()["ndcg_at_3"] or 0.0
    return {"maxDepth": max(scored, key=lambda d: (scored[d], -d))}


def train(spark: SparkSession, merged: DataFrame, uid: str, min_tenant_rows: int = 500,
          reg_iter: int = 50, model_name: str = "gbt", stored: DataFrame | None = None,
          duration_grid: dict | None = None, ranker_depths: list[int] = (),
          save_to: str | None = None) -> TrainResult:
    """M1-M3, M5, M7-M12, M17, M18 in the reference's order: codes → row split → parameters (best
    stored run, else tuned) → duration model (early stopping on validation rows, per tenant with
    fallback) → group labels and group split → score model likewise → NDCG and hit rate on
    validation → metrics record → gate against the best stored run → models, metadata and
    dictionary saved if it passes. ``stored`` is the table of earlier metrics records."""
    d = prepare_training_frame(merged)
    cats = [c for c in E.CATEGORICAL if c in d.columns]
    nums = [c for c in E.NUMERICAL if c in d.columns]
    dic = E.category_dictionary(d, cats)                                  # R24: full frame
    coded = E.apply_dictionary(d, dic, cats, unknown_code=-1, suffix="_code")
    feats = [f"{c}_code" for c in cats] + nums
    coded = coded.withColumns({f"{c}_code": F.col(f"{c}_code").cast("double") for c in cats})
    coded = M.row_split(coded, uid)
    reg_params = best_duration_params(coded.where("is_train"), feats, stored, model_name, duration_grid)
    # early stopping looks at a tenth of the training rows, so the validation rows stay unseen
    stop = F.pmod(F.xxhash64(uid), F.lit(10)) == 0
    rows_to_fit = coded.where("is_train").withColumn("stop_row", stop)
    shape = {"max_iter": reg_iter, "max_depth": int(reg_params.get("maxDepth", 5)),
             "step": float(reg_params.get("stepSize", 0.1))}
    tenant_pipe = ML.boosted_trees(feats, TARGET_TIME, **shape)
    reg_pipe = tenant_pipe if rows_to_fit.where("stop_row").isEmpty() else ML.boosted_trees(
        feats, TARGET_TIME, validation_col="stop_row", **shape)
    reg = ML.fit_per_tenant(reg_pipe, rows_to_fit, "con", min_tenant_rows, tenant_pipeline=tenant_pipe)
    val = coded.where(~F.col("is_train"))
    reg_metrics = M.regression_metrics(reg.transform(val), TARGET_TIME, "prediction")

    g = coded.withColumn("_group_key", composite_key(*GROUP_COLS))\
        .withColumn("_rank_label", M.relevance_label(TARGET_RANK))
    g = M.group_split(g, ["_group_key"], out="group_train")
    rank_name = f"{model_name}_rank"
    rank_params = best_ranker_params(g.where("group_train"), feats, stored, rank_name, list(ranker_depths))
    rank_pipe = ML.random_forest(feats, TARGET_RANK, num_trees=50, max_depth=int(rank_params.get("maxDepth", 8)))
    ranker = ML.fit_per_tenant(rank_pipe, g.where("group_train"), "con", min_tenant_rows, "_group_key")
    gv = ranker.transform(g.where(~F.col("group_train")))
    nd = M.ndcg_at_k(gv, ["_group_key"], TARGET_RANK, "prediction", [3, 5])

    # hit rate: 500 validation rows, every employee of the tenant, the row's other features
    emp = "URENVERANTW_MEDID_code"
    sampled = hash_sample(g.where(~F.col("group_train")), uid, 500)\
        .withColumnRenamed(emp, "actual").drop("features", "prediction")
    people = g.select("con", emp).distinct()
    # a tenant with one employee is a sure hit: skipped
    several = people.groupBy("con").count().where("count > 1").select("con")
    sampled = sampled.join(several, "con", "left_semi")
    cand = expand_candidates(sampled, people, "con")      # J15: bounded request broadcast
    scored = ranker.transform(cand).drop("features")
    top = ML.rank_candidates(scored, uid, "prediction", emp, k=3)
    hits = top.where(F.col(emp) == F.col("actual")).select(uid).distinct()
    hr = sampled.select(uid).join(hits.withColumn("h", F.lit(1)), uid, "left").agg(
        (F.count("h") / F.count(F.lit(1))).alias("top3_hit_rate"))

    params = json.dumps({"reg_max_iter": reg_iter, "rank_trees": 50, **reg_params})
    rows = reg_metrics.select(
        F.lit(model_name).alias("model"), F.lit(params).alias("params"),
        F.col("mae").alias("time_mae"), F.col("rmse").alias("time_rmse"),
        F.col("r2").alias("time_r2"), F.col("n").alias("dataset_rows"))
    from hourloom.operators.quality import side_by_side
    metrics = side_by_side(rows, nd.select("ndcg_at_3", "ndcg_at_5"), hr)
    gated = M.champion_gate(stored, metrics) if stored is not None else None
    registered = gated is None or bool(gated.first()["register"])
    if registered and save_to:
        ML.save_model(spark, reg.base, f"{save_to}/duration", feats, [TARGET_TIME], json.loads(params))
        ML.save_model(spark, ranker.base, f"{save_to}/ranker", feats, [TARGET_RANK], rank_params)
        for kind, models in (("duration", reg), ("ranker", ranker)):
            for tenant, model in models.per_tenant.items():
                model.write().overwrite().save(f"{save_to}/{kind}/tenants/{tenant}")
        dic.write.mode("overwrite").json(f"{save_to}/dictionary")
        rank_row = metrics.select(F.lit(rank_name).alias("model"), F.lit(json.dumps(rank_params)).alias("params"),
                                  (-F.col("ndcg_at_3")).alias("neg_ndcg_at_3"))
        metrics.unionByName(rank_row, allowMissingColumns=True).write.mode("overwrite").parquet(f"{save_to}/metrics")
    return TrainResult(reg, ranker, dic, metrics, feats, registered)
