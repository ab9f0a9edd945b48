"""Spark ML model queries (M4-M9, M13, M15, M16, M18-M20). Model outputs depend on the learner's
randomness and floating point, so most are rows-only checks (no DuckDB twin), plus unit tests
of their invariants; where SQL can tell the result (the saved model scores as before; which
tenants get a model of their own) it does."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hourloom.operators import boosting as B
from hourloom.operators import encode as E
from hourloom.operators import metrics as M
from hourloom.operators import models as ML
from hourloom.operators.forest import fit_forest
from hourloom.operators.relational import hash_sample
from hourloom.operators.search import Range, search
from hourloom.plans.catalog.scoring import md5_bucket_sql
from hourloom.plans.registry import register
from hourloom.session import checkpoint_dir, materialize, materialize_evenly
from hourloom.sources.tables import read_table

FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "brand_code",
            "person_code"]
# the row's identity as one number that SQL can also make
_ROW_KEY = "l_orderkey * 1000003 + l_partkey * 8191 + l_suppkey * 131 + l_linenumber"
_VALIDATION_SQL = f"""
SELECT * FROM (SELECT l.*, {_ROW_KEY} AS k FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
WHERE {md5_bucket_sql("CAST(k AS VARCHAR)")} >= 80"""
ID_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def model_frame(spark, sf):
    """Stand-in training frame: line items with part attributes; tenant = return flag,
    task = order line, person = supplier; targets = extended price (time) and a 0..1 score."""
    li = read_table(spark, sf, "lineitem")
    p = read_table(spark, sf, "part")
    j = li.join(p, li.l_partkey == p.p_partkey).select(
        *ID_COLS, F.col("l_returnflag").alias("con"), "l_quantity", "l_discount", "l_tax",
        "p_size", "p_retailprice", "p_brand",
        F.col("l_suppkey").cast("double").alias("person_code"),
        F.col("l_extendedprice").alias("REAL_WORKED_TIME"),
        F.least(F.col("l_discount") * 10.0, F.lit(1.0)).alias("suitability_score"))
    d = E.category_dictionary(j, ["p_brand"])
    j = E.apply_dictionary(j, d, ["p_brand"], unknown_code=-1, suffix="_code")\
        .withColumnRenamed("p_brand_code", "brand_code")
    j = j.withColumn("brand_code", F.col("brand_code").cast("double"))
    return M.row_split(j.withColumn("__k", F.expr(_ROW_KEY)), "__k")


def _train_val(spark, sf, f=None):
    """Training and validation rows of the frame, written once: a fit reads it several times."""
    f = materialize_evenly(model_frame(spark, sf)) if f is None else f
    return f.where("is_train"), f.where(~F.col("is_train"))


def _metrics(df, label="REAL_WORKED_TIME"):
    m = M.regression_metrics(df, label, "prediction")
    return m.select("n", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2")])


@register("m4_random_forest")
def m4_random_forest(spark, sf):
    """M4: random-forest duration regressor (200 trees, √ features, seed 42), validation
    metrics."""
    tr, va = _train_val(spark, sf)
    m = fit_forest(ML.random_forest(FEATURES, "REAL_WORKED_TIME"), tr)
    return _metrics(m.transform(va))


@register("m5_boosted_trees_early_stop")
def m5_boosted_trees_early_stop(spark, sf):
    """M5: boosted trees (absolute loss) with early stopping on a validation indicator."""
    f = model_frame(spark, sf).withColumn("is_val", ~F.col("is_train"))
    m = ML.boosted_trees(FEATURES, "REAL_WORKED_TIME", max_iter=60,
                         validation_col="is_val").fit(f)
    out = _metrics(m.transform(f.where("is_val")))
    return out.withColumn("trees", F.lit(m.stages[-1].getNumTrees))


@register("m6_huber_regression")
def m6_huber_regression(spark, sf):
    """M6: robust (Huber) linear regression."""
    tr, va = _train_val(spark, sf)
    m = ML.huber_regression(FEATURES, "REAL_WORKED_TIME").fit(tr)
    return _metrics(m.transform(va))


@register("m7_m13_who_to_plan")
def m7_m13_who_to_plan(spark, sf):
    """Pointwise ranker + time model; for 20 requested order lines, every supplier of
    the tenant with predicted hours and score, best first."""
    f = materialize_evenly(model_frame(spark, sf))
    tr, _ = _train_val(spark, sf, f)
    tm = ML.boosted_trees(FEATURES, "REAL_WORKED_TIME", max_iter=20).fit(tr)
    sm = fit_forest(ML.random_forest(FEATURES, "suitability_score", num_trees=20, max_depth=6), tr)
    req = hash_sample(f, "__k", 20).select(
        "con", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "p_size",
        "p_retailprice", "brand_code")
    people = f.select("con", "l_suppkey").distinct()\
        .withColumn("person_code", F.col("l_suppkey").cast("double"))
    plan = ML.who_to_plan(req.withColumn("task", F.struct("l_orderkey", "l_linenumber")), people,
                          "con", "task", "l_suppkey", tm, sm)
    return plan.select("l_orderkey", "l_linenumber", "l_suppkey", "predicted_hours",
                       "predicted_score", "rank")


@register("m8_per_tenant_models")
def m8_per_tenant_models(spark, sf):
    """M8: per-tenant models (≥ 500 rows) with fallback to the base model; validation metrics
    per tenant of the routed predictions."""
    tr, va = _train_val(spark, sf)
    tm = ML.fit_per_tenant(ML.boosted_trees(FEATURES, "REAL_WORKED_TIME", max_iter=20), tr,
                           "con", min_rows=500)
    pred = tm.transform(va)
    m = M.regression_metrics(pred, "REAL_WORKED_TIME", "prediction", ["con"])
    return m.select("con", "n", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2")],
                    F.col("con").isin(list(tm.per_tenant)).alias("specialised"))


@register("m8_routing", f"""
WITH s AS (SELECT l.l_returnflag AS con, l.l_linestatus, {_ROW_KEY} AS k
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
t AS (SELECT con, {md5_bucket_sql("CAST(k AS VARCHAR)")} < 80 AS is_train FROM s)
SELECT con, CAST(count(*) FILTER (WHERE NOT is_train) AS BIGINT) AS n,
       count(*) FILTER (WHERE is_train) >= 16000 AS specialised
FROM t GROUP BY con HAVING count(*) FILTER (WHERE NOT is_train) > 0
""")
def m8_routing(spark, sf):
    """M8: rows per tenant scored by its own model or, below 16,000 training rows, by the base."""
    tr, va = _train_val(spark, sf)
    tm = ML.fit_per_tenant(ML.random_forest(FEATURES, "REAL_WORKED_TIME", num_trees=5, max_depth=4), tr, "con",
                           min_rows=16_000)
    return tm.transform(va).groupBy("con").agg(F.count("prediction").cast("long").alias("n")).select(
        "con", "n", F.col("con").isin(list(tm.per_tenant)).alias("specialised"))


@register("m9_tuning")
def m9_tuning(spark, sf):
    """M9: grid search (tree depth × step) with a train/validation split; best parameters."""
    tr, _ = _train_val(spark, sf)
    pipe = ML.boosted_trees(FEATURES, "REAL_WORKED_TIME", max_iter=15)
    m, best = ML.tune(pipe, lambda est, g: g.addGrid(est.maxDepth, [3, 5])
                      .addGrid(est.stepSize, [0.1, 0.3]), tr, "REAL_WORKED_TIME")
    rows = [(k, float(v)) for k, v in sorted(best.items()) if k in ("maxDepth", "stepSize")]
    rows.append(("best_validation_mae", float(min(m.validationMetrics))))
    return spark.createDataFrame(rows, "name string, value double")


@register("m15_feature_importances")
def m15_feature_importances(spark, sf):
    """Random-forest feature importances, top 20."""
    tr, _ = _train_val(spark, sf)
    m = ML.random_forest(FEATURES, "REAL_WORKED_TIME", num_trees=50).fit(tr)
    return ML.feature_importances(spark, m, FEATURES)


@register("m16_permutation_importance")
def m16_permutation_importance(spark, sf):
    """MAE increase per permuted feature on a 2000-row validation sample."""
    tr, va = _train_val(spark, sf)
    m = ML.random_forest(FEATURES, "REAL_WORKED_TIME", num_trees=30).fit(tr)
    sample = hash_sample(va, "__k", 2000)
    out = ML.permutation_importance(m, sample, FEATURES, "REAL_WORKED_TIME", ID_COLS)
    return out.select("feature", F.round("mae", 4).alias("mae"),
                      F.round("mae_increase", 4).alias("mae_increase"))


@register("m18_m19_persist_and_agree", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS DOUBLE) AS max_abs_diff, CAST(0 AS DOUBLE) AS mean_abs_diff
FROM ({_VALIDATION_SQL}) v
""")
def m18_m19_persist_and_agree(spark, sf):
    """Save model + metadata to the shared folder, reload, and compare both scorers."""
    tr, va = _train_val(spark, sf)
    m = ML.random_forest(FEATURES, "REAL_WORKED_TIME", num_trees=30).fit(tr)
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    ML.save_model(spark, m, path, FEATURES, ["REAL_WORKED_TIME"], {"numTrees": 30})
    again = ML.load_model(path)
    return ML.scorer_agreement(m, again, va)


@register("m20_batch_scoring")
def m20_batch_scoring(spark, sf):
    """Batch scoring output {row_index, features, predicted_time, predicted_suitability}."""
    tr, va = _train_val(spark, sf)
    tm = ML.boosted_trees(FEATURES, "REAL_WORKED_TIME", max_iter=20).fit(tr)
    sm = fit_forest(ML.random_forest(FEATURES, "suitability_score", num_trees=20, max_depth=6), tr)
    v = va.withColumn("row_index", F.col("__k")).withColumn(
        "vec", F.array(*[F.col(c).cast("double") for c in FEATURES]))
    return ML.batch_score(v, "row_index", "vec", tm, sm)


# ── trees of our own: Huber, listwise, warm-started (M5-M8, M15) ─────────────

def charge_frame(spark, sf):
    """Stand-in for durations that features can tell: a line's charge, out of price, discount and tax."""
    return model_frame(spark, sf).withColumns({
        "price": F.col("REAL_WORKED_TIME"),
        "REAL_WORKED_TIME": F.expr("REAL_WORKED_TIME * (1 - l_discount) * (1 + l_tax)")})


_NUMERIC, _CODES = ["price", "l_quantity", "l_discount", "l_tax", "p_size"], ["p_brand"]
_CHARGE_COLS = [*_NUMERIC, *_CODES, "REAL_WORKED_TIME", "__k", "is_train"]
_PARAMS = B.Params(trees=5, learning_rate=0.6, max_depth=4, patience=2)


def _huber_model(spark, sf, params=_PARAMS):
    f = materialize_evenly(charge_frame(spark, sf).select(*_CHARGE_COLS, "l_suppkey"))
    bins = B.fit_bins(f.where("is_train"), _NUMERIC, _CODES)
    return f, B.fit_huber(f, bins, "REAL_WORKED_TIME", "__k", params, ~F.col("is_train"))


_CHARGE_SQL = f"""
SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y, {md5_bucket_sql("CAST(k AS VARCHAR)")} < 80 AS is_train
FROM (SELECT l.*, p.p_size, p.p_brand, {_ROW_KEY} AS k FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


@register("m5_m6_huber_trees", f"""
WITH s AS ({_CHARGE_SQL})
SELECT CAST(count(*) AS BIGINT) AS n, true AS explains_nine_tenths, true AS below_median_error FROM s WHERE NOT is_train
""")
def m5_m6_huber_trees(spark, sf):
    """M5/M6: boosted trees with Huber loss, stopped early on the held-out rows: their number, and whether
    the model explains nine tenths of their variance and errs less than the training median."""
    f, model = _huber_model(spark, sf)
    held = model.predict(f.where(~F.col("is_train")))
    m = M.regression_metrics(held, "REAL_WORKED_TIME", "prediction").crossJoin(  # one row each
        held.agg(F.avg(F.abs(F.col("REAL_WORKED_TIME") - model.init)).alias("plain")))
    return m.select("n", (F.col("r2") > 0.9).alias("explains_nine_tenths"), (F.col("mae") < F.col("plain")).alias("below_median_error"))


@register("m5_m6_huber_tree_table")
def m5_m6_huber_tree_table(spark, sf):
    """The trees that are kept, with each split's feature, cut or categories, and gain."""
    _, model = _huber_model(spark, sf)
    return model.kept().select("tree", "node", F.get(F.array(*[F.lit(n) for n in model.binning.features]), "feature").alias("feature"),
                               "cut", "bits", F.round("gain", 6).alias("gain"), F.round("value", 6).alias("value"))


@register("m5_root_histogram", f"""
WITH s AS (SELECT * FROM ({_CHARGE_SQL}) WHERE is_train),
m AS (SELECT quantile_cont(y, 0.5) AS mid FROM s),
d AS (SELECT mid, quantile_cont(abs(y - mid), 0.9) AS delta FROM s, m GROUP BY mid),
g AS (SELECT s.*, CAST(round(greatest(least(y - mid, delta), -delta) / delta * 1048576) AS BIGINT) AS g FROM s, d),
u AS (SELECT 'l_quantity' AS feature, dense_rank() OVER (ORDER BY l_quantity) AS bin, g FROM g
      UNION ALL SELECT 'l_discount', dense_rank() OVER (ORDER BY l_discount), g FROM g
      UNION ALL SELECT 'l_tax', dense_rank() OVER (ORDER BY l_tax), g FROM g)
SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n, round(CAST(sum(g) AS DOUBLE) / 1048576, 3) AS g
FROM u GROUP BY ALL
""")
def m5_root_histogram(spark, sf):
    """M5: the first level's sums of Huber gradients by feature and bin (every value has a bin of its own)."""
    f = charge_frame(spark, sf).where("is_train")
    bins = B.fit_bins(f, ["l_quantity", "l_discount", "l_tax"], bins=1000)
    rows = materialize(B.prepare(f, bins, "REAL_WORKED_TIME", "__k"))
    mid, delta = B.label_scale(rows, "y")
    start = B.Huber(delta).gradients(rows.withColumn("margin", F.lit(mid))).withColumn("node", F.lit(1))
    return B.histogram(start).select(F.get(F.array(*[F.lit(n) for n in bins.features]), "feature").alias("feature"), "bin", "n",
                                     F.round(F.col("g") / B.UNIT, 3).alias("g"))


_GRADE = "CAST(least(floor(l_discount * 50), 4) AS DOUBLE)"


@register("m7_lambda_gradients", f"""
WITH s AS (SELECT l_orderkey AS grp, {_ROW_KEY} AS id, {_GRADE} AS y FROM lineitem JOIN part ON l_partkey = p_partkey),
p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY id) AS place,
             row_number() OVER (PARTITION BY grp ORDER BY y DESC, id) AS best FROM s),
i AS (SELECT grp, sum(CASE WHEN best <= 3 THEN (pow(2, y) - 1) / log2(best + 1) ELSE 0 END) AS ideal FROM p GROUP BY grp),
q AS (SELECT a.id, sign(a.y - b.y) AS up,
             abs(pow(2, a.y) - pow(2, b.y)) * abs(CASE WHEN a.place <= 3 THEN 1 / log2(a.place + 1) ELSE 0 END
                                                 - CASE WHEN b.place <= 3 THEN 1 / log2(b.place + 1) ELSE 0 END) / i.ideal AS swap
      FROM p a JOIN p b ON a.grp = b.grp AND a.id <> b.id AND a.y <> b.y AND (a.place <= 3 OR b.place <= 3) JOIN i ON i.grp = a.grp),
t AS (SELECT id, sum(round(up * swap / 2 * 1073741824)) AS g, sum(round(swap / 4 * 1073741824)) AS h FROM q GROUP BY id)
SELECT p.grp AS l_orderkey, p.id, CAST(round(coalesce(t.g, 0) / 1024) AS BIGINT) AS g,
       CAST(round(coalesce(t.h, 0) / 1024) AS BIGINT) AS h FROM p LEFT JOIN t ON p.id = t.id
""")
def m7_lambda_gradients(spark, sf):
    """M7: listwise gradients and curvatures of the first round (all margins 0), NDCG cut at 3; groups are orders."""
    f = charge_frame(spark, sf).withColumn("grade", F.expr(_GRADE))
    rows = B.prepare(f, B.Binning({}), "grade", "__k", group="l_orderkey")
    return B.LambdaRank(3).gradients(rows).select(F.col("grp").cast("long").alias("l_orderkey"), "id", "g", "h")


@register("m7_listwise_ranker")
def m7_listwise_ranker(spark, sf):
    """A listwise ranker over the lines of orders, split by order; held-out NDCG at 3 and 5."""
    f = M.group_split(charge_frame(spark, sf).withColumn("grade", F.expr(_GRADE)), ["l_orderkey"], out="learned")
    f = materialize_evenly(f.select("price", "REAL_WORKED_TIME", "l_quantity", "l_tax", "grade", "l_orderkey", "__k", "learned"))
    bins = B.fit_bins(f.where("learned"), ["price", "REAL_WORKED_TIME", "l_quantity", "l_tax"])
    model = B.fit_ranker(f, bins, "grade", "l_orderkey", "__k", B.Params(trees=4, learning_rate=0.3, max_depth=3, patience=2),
                         ~F.col("learned"))
    found = M.ndcg_at_k(model.predict(f.where(~F.col("learned"))), ["l_orderkey"], "grade", "prediction", [3, 5])
    return found.select("groups", F.round("ndcg_at_3", 4).alias("ndcg_at_3"), F.round("ndcg_at_5", 4).alias("ndcg_at_5"))


@register("m8_fine_tuned_tenants", f"""
WITH s AS (SELECT *, l_suppkey % 40 AS con FROM ({_CHARGE_SQL}))
SELECT CAST(con AS VARCHAR) AS con, CAST(count(*) FILTER (WHERE NOT is_train) AS BIGINT) AS n, count(*) >= 1500 AS tuned,
       true AS at_least_as_good
FROM s GROUP BY con HAVING count(*) FILTER (WHERE NOT is_train) > 0
""")
def m8_fine_tuned_tenants(spark, sf):
    """M8: trees for all tenants with 1,500 rows or more, grown together from the base's margins; per tenant its
    held-out rows, whether it has trees of its own, and that its held-out error is not above the base's."""
    f, base = _huber_model(spark, sf, B.Params(trees=3, learning_rate=0.5, max_depth=3))
    f = f.withColumn("con", (F.col("l_suppkey") % 40).cast("string"))
    tuned = B.fine_tune(base, f, "REAL_WORKED_TIME", "__k", "con", B.Params(trees=4, learning_rate=0.3, max_depth=3, patience=2),
                        ~F.col("is_train"), min_rows=1500)
    held = f.where(~F.col("is_train"))
    both = tuned.predict(base.predict(held, "base_hours"), tenant="con")
    unit = base.objective.delta / B.UNIT  # errors count in the whole-number steps that the growth compares
    off = {c: F.sum(F.round(F.abs(F.col("REAL_WORKED_TIME") - F.col(c)) / unit).cast("decimal(38,0)")) for c in ("prediction", "base_hours")}
    per = both.groupBy("con").agg(F.count("*").alias("n"), (off["prediction"] <= off["base_hours"]).alias("at_least_as_good"))
    own = tuned.best.select(F.col("tenant").alias("con"), F.lit(True).alias("own"))
    return per.join(own, "con", "left").select("con", "n", F.coalesce("own", F.lit(False)).alias("tuned"), "at_least_as_good")


@register("m15_gain_importances")
def m15_gain_importances(spark, sf):
    """Share of the Huber trees' total gain by feature."""
    _, model = _huber_model(spark, sf)
    return model.importances().select("feature", F.round("importance", 6).alias("importance"))


@register("m9_adaptive_search")
def m9_adaptive_search(spark, sf):
    """M9: learning rate, depth and leaf size of the Huber trees by adaptive search; half of each batch ends on
    half of the trees. The trial table, one row a fit."""
    f = materialize_evenly(charge_frame(spark, sf).select(*_CHARGE_COLS))
    bins, scale = B.fit_bins(f.where("is_train"), _NUMERIC), B.label_scale(f.where("is_train"), "REAL_WORKED_TIME")
    blocks = B.huber_blocks(f, bins, "REAL_WORKED_TIME", "__k", scale[0], ~F.col("is_train"))

    def loss(p, budget):
        params = B.Params(trees=max(1, round(2 * budget)), learning_rate=p["learning_rate"], max_depth=p["max_depth"],
                          min_child_samples=p["min_child_samples"])
        model = B.fit_huber(f, bins, "REAL_WORKED_TIME", "__k", params, ~F.col("is_train"), scale=scale, blocks=blocks)
        return M.regression_metrics(model.predict(f.where(~F.col("is_train"))), "REAL_WORKED_TIME", "prediction").first()["mae"]

    space = {"learning_rate": Range(0.1, 1.0, log=True), "max_depth": Range(2, 4, step=1), "min_child_samples": Range(10, 100, step=10)}
    found = search(spark, space, loss, trials=4, batch=2, start=2, rungs=(0.5, 1.0))
    return found.select("trial", "params", "budget", F.round("loss", 2).alias("loss"), "reused")
