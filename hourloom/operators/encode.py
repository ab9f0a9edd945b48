"""Category dictionaries (X6), applying them with an unknown-value policy (X7), train-set scaling
(X8, see ``aggregates.apply_zscore``) and the fixed 36-slot serving feature vector (X9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.columns import cyclic, iso_week, weekday_sun0
from hourloom.operators.relational import bounded_broadcast

# The model's feature order (11 categorical then 25 numeric) and the serving rules.
CATEGORICAL = [
    "URENVERANTW_MEDID", "BEWERKING_ID", "DIENST_ART_ID", "RELATIE_ID", "REL_POSTCODE",
    "DIENST_ART_OMS", "MACH_OMS", "con", "bron", "EquipmentGroupTypes", "planninggroupsname",
]
NUMERICAL = [
    "lat", "lon", "dag_sin", "dag_cos", "maand_sin", "maand_cos", "week_sin", "week_cos",
    "med_std_tijd", "med_aantal_opdrachten", "med_ervaring_bewerking", "med_gem_tijd", "taak_gem",
    "med_klant_bezoeken", "med_klant_ratio", "med_klant_snelheid", "med_bewerking_snelheid",
    "med_klant_gem_tijd", "med_bewerking_gem_tijd", "med_totaal_opdrachten",
    "hoeveelheid_volume", "hoeveelheid_gewicht", "hoeveelheid_stuks", "hoeveelheid_aanwezig",
    "hoeveelheid_baal",
]
FEATURES = CATEGORICAL + NUMERICAL
SERVING_DEFAULT_DATE = "2020-01-01"
CYCLIC_FEATURES = ["dag_sin", "dag_cos", "maand_sin", "maand_cos", "week_sin", "week_cos"]


SMALL_DICTIONARY = 1_000_000


def category_dictionary(df: DataFrame, cols: Sequence[str], unknown: str | None = None,
                        ranges: int | None = None) -> DataFrame:
    """Per column, the sorted distinct values coded 0..n-1 → (column_name, value, code).

    Values are compared as strings (after the optional NULL fill ``unknown``). The distinct
    (column, value) pairs are materialised once. Up to ``SMALL_DICTIONARY`` pairs they are ranked
    with one window per column (bounded input). Above that they are range-partitioned into
    balanced, contiguous ranges, ranked inside each range and shifted by the number of values of
    the same column in earlier ranges (a small per-range count table) — a high-cardinality
    column is never ranked in a single task."""
    from hourloom.session import materialize

    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, value)")
    if unknown is not None:
        long = long.withColumn("value", F.coalesce("value", F.lit(unknown)))
    long = materialize(long.where(F.col("value").isNotNull()).distinct())
    if ranges is None and long.count() <= SMALL_DICTIONARY:
        w = Window.partitionBy("column_name").orderBy("value")
        return long.withColumn("code", (F.row_number().over(w) - 1).cast("int"))
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    r = materialize(long.repartitionByRange(n, "column_name", "value")
                    .withColumn("__p", F.spark_partition_id()))
    local = r.withColumn("__i", F.row_number().over(
        Window.partitionBy("__p", "column_name").orderBy("value")) - 1)
    cnt = r.groupBy("column_name", "__p").agg(F.count(F.lit(1)).alias("__n"))
    off = cnt.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.partitionBy("column_name").orderBy("__p")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per (column, range): bounded by #columns × ranges → broadcast
    j = local.join(F.broadcast(off.select("column_name", "__p", "__off")), ["column_name", "__p"])
    return j.select("column_name", "value", (F.col("__i") + F.col("__off")).cast("int")
                    .alias("code"))


def cardinality(dictionary: DataFrame) -> DataFrame:
    """Cardinality report per column."""
    return dictionary.groupBy("column_name").agg(F.count(F.lit(1)).cast("long").alias("n_values"))


def apply_dictionary(df: DataFrame, dictionary: DataFrame, cols: Sequence[str],
                     unknown_code: int | None = -1, suffix: str = "",
                     fill: str | None = None) -> DataFrame:
    """Replace each categorical value by its code; values absent from the dictionary get
    ``unknown_code`` (−1 for the forest, 0 for serving; ``None`` keeps NULL). ``fill`` maps NULL
    inputs to the unknown category first (MLP policy)."""
    out = df
    for c in cols:
        d = dictionary.where(F.col("column_name") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
        key = F.col(c).cast("string")
        if fill is not None:
            key = F.coalesce(key, F.lit(fill))
        out = out.withColumn(f"__k_{c}", key)
        out = out.join(bounded_broadcast(d), out[f"__k_{c}"] == d[f"__v_{c}"], "left")
        code = F.col(f"__c_{c}")
        if unknown_code is not None:
            code = F.coalesce(code, F.lit(unknown_code))
        out = out.withColumn(c + suffix, code.cast("int")).drop(f"__v_{c}", f"__c_{c}", f"__k_{c}")
    return out


def serving_vector(df: DataFrame, codes: Mapping[str, str], date_col: str,
                   categorical: Sequence[str] = CATEGORICAL, numerical: Sequence[str] = NUMERICAL,
                   out: str = "features", model_input: str | None = None) -> DataFrame:
    """The fixed 36-slot serving vector.

    Slots: the 11 category codes (unknown → 0; ``codes`` maps feature → code column), lat/lon,
    the six cyclic values recomputed from the date with **Sunday = 0** (train/serve skew R16,
    kept on purpose), then the remaining numeric features with NULL → 0. An unparsable date
    falls back to 2020-01-01. ``out`` holds the values rounded half-even to 6 decimals as doubles
    (the parity record); ``model_input`` optionally adds the unrounded ``float32`` copy that a
    model consumes. (Rounding works on the shortest decimal form of the double; Python's round
    uses the exact binary value — they differ only on a 7th-decimal 5 that is inexact in
    binary.)"""
    d = F.coalesce(F.try_to_timestamp(F.col(date_col).cast("string")).cast("date"),
                   F.lit(SERVING_DEFAULT_DATE).cast("date"))
    ds, dc = cyclic(weekday_sun0(d), 7)
    ms, mc = cyclic(F.month(d), 12)
    ws, wc = cyclic(iso_week(d), 52)
    cyc = dict(zip(CYCLIC_FEATURES, [ds, dc, ms, mc, ws, wc]))
    slots: list[Column] = []
    for c in categorical:
        slots.append(F.coalesce(F.col(codes[c]).cast("double"), F.lit(0.0))
                     if c in codes else F.lit(0.0))
    for c in numerical:
        if c in cyc:
            slots.append(cyc[c])
        elif c in df.columns:
            slots.append(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                    F.lit(0.0)))
        else:
            slots.append(F.lit(0.0))
    res = df.withColumn(out, F.array(*[F.bround(s, 6) for s in slots]))
    if model_input:
        res = res.withColumn(model_input, F.array(*[s.cast("float") for s in slots]))
    return res
