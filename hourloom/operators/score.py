"""Suitability score (X5), canonical merge of the two planning systems (X10), employee profiles
(X11) and their usability summary (X12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.columns import known, rename_columns, select_available, with_provenance
from hourloom.operators.aggregates import concentration
from hourloom.operators.relational import bounded_broadcast, union_all_by_name

# Source-A column → canonical (system B) column names, the source-A-only columns,
# the provenance tags of the two sources (values of the `bron` category) and the score weights.
COLUMN_MAPPING = {
    "EmployeeId": "URENVERANTW_MEDID",
    "ServiceLineId_x": "DIENST_ART_ID",
    "PlanningGroupId": "BEWERKING_ID",
    "ClientId": "RELATIE_ID",
    "servicelinesname": "DIENST_ART_OMS",
    "equipmentname": "MACH_OMS",
    "PostalCode": "REL_POSTCODE",
    "lat": "lat",
    "lon": "lon",
    "Datum": "URENVERANTW_DATUM",
    "dag_sin": "dag_sin",
    "dag_cos": "dag_cos",
    "maand_sin": "maand_sin",
    "maand_cos": "maand_cos",
    "week_sin": "week_sin",
    "week_cos": "week_cos",
    "med_gem_tijd": "med_gem_tijd",
    "med_std_tijd": "med_std_tijd",
    "med_aantal_opdrachten": "med_aantal_opdrachten",
    "med_ervaring_bewerking": "med_ervaring_bewerking",
    "taak_gem": "taak_gem",
    "med_klant_bezoeken": "med_klant_bezoeken",
    "med_klant_ratio": "med_klant_ratio",
    "med_klant_snelheid": "med_klant_snelheid",
    "med_bewerking_snelheid": "med_bewerking_snelheid",
    "med_klant_gem_tijd": "med_klant_gem_tijd",
    "med_bewerking_gem_tijd": "med_bewerking_gem_tijd",
    "med_totaal_opdrachten": "med_totaal_opdrachten",
    "hoeveelheid_big_bag": "hoeveelheid_volume",
    "hoeveelheid_dag": "hoeveelheid_gewicht",
    "hoeveelheid_hectare": "hoeveelheid_stuks",
    "hoeveelheid_kubieke_meter": "hoeveelheid_aanwezig",
    "TenantId_x": "con",
    "hoeveelheid_uur": "REAL_WORKED_TIME",
}
SOURCE_A_ONLY = ["EquipmentGroupTypes", "planninggroupsname", "hoeveelheid_baal"]
SOURCE_A_TAG = "rister"
SOURCE_B_TAG = "werkxpert"
EXPERIENCE_WEIGHT = 0.6
VISITS_WEIGHT = 0.4


def suitability_score(df: DataFrame, tenant: str = "con",
                      experience: str = "med_ervaring_bewerking",
                      visits: str = "med_klant_bezoeken", out: str = "suitability_score"
                      ) -> DataFrame:
    """``clip(0.6·exp/max_tenant(exp) + 0.4·visits/max_tenant(visits), 0, 1)`` as float32,
    each normalisation 0 when the tenant max is ≤ 0 (G11).

    The input is written once (it usually ends in a chain of windows); both maxima come from one
    aggregate over it (one row per tenant), joined back after a size check."""
    from hourloom.session import materialize
    df = materialize(df)
    mx = df.groupBy(tenant).agg(F.max(known(experience)).alias("__mx_e"), F.max(known(visits)).alias("__mx_v"))
    j = df.join(bounded_broadcast(mx), on=tenant, how="left")

    def norm(c, m):
        return F.when(F.col(m) > 0, F.col(c).cast("double") / F.col(m)).otherwise(F.lit(0.0))

    s = (F.lit(EXPERIENCE_WEIGHT) * norm(experience, "__mx_e")
         + F.lit(VISITS_WEIGHT) * norm(visits, "__mx_v"))
    s = F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0))
    return j.withColumn(out, s.cast("float")).drop("__mx_e", "__mx_v")


def canonical_merge(source_a: DataFrame, source_b: DataFrame,
                    mapping: Mapping[str, str] = COLUMN_MAPPING,
                    a_only: Sequence[str] = SOURCE_A_ONLY,
                    a_tag: str = SOURCE_A_TAG, b_tag: str = SOURCE_B_TAG) -> DataFrame:
    """Bring both sources to one schema and union them (system B rows first).

    Source A: keep the mapped + A-only columns that exist, rename to canonical names, tag ``bron``.
    Source B: keep the canonical names that exist, tag ``bron``. Union by name; a column present in
    one source only is NULL for the other."""
    from hourloom.operators.encode import CATEGORICAL

    def as_categories(df: DataFrame) -> DataFrame:
        # ids are categories; typing them as strings keeps the union free of lossy casts
        return df.withColumns({c: F.col(c).cast("string") for c in CATEGORICAL
                               if c in df.columns})

    a, _ = select_available(source_a, list(mapping) + list(a_only))
    a = as_categories(with_provenance(rename_columns(a, mapping), "bron", a_tag))
    b_cols = list(dict.fromkeys(mapping.values()))
    b, _ = select_available(source_b, b_cols)
    b = as_categories(with_provenance(b, "bron", b_tag))
    return union_all_by_name(b, a)


def employee_profiles(df: DataFrame, employee: Sequence[str], client: str, task: str
                      ) -> DataFrame:
    """X11: per employee — unique clients, client concentration (Herfindahl), unique tasks, task
    specialisation (max share) and total jobs, from two grouped pre-counts joined on the
    employee key (J18)."""
    ek = F.struct(*[F.col(c) for c in employee])
    d = df.withColumn("__ek", ek)
    cl = concentration(d, "__ek", client).select(
        "__ek", F.col("unique_items").alias("unique_clients"),
        F.col("herfindahl").alias("client_herfindahl"), F.col("total_rows").alias("total_jobs"))
    tk = concentration(d, "__ek", task).select(
        "__ek", F.col("unique_items").alias("unique_tasks"),
        F.col("specialisation").alias("task_specialisation"))
    j = cl.join(tk, "__ek", "inner")
    return j.select(*[F.col(f"__ek.{c}").alias(c) for c in employee], "unique_clients",
                    "client_herfindahl", "unique_tasks", "task_specialisation", "total_jobs")


def profile_summary(profiles: DataFrame, min_jobs: int = 20, high: float = 0.8,
                    low: float = 0.4) -> DataFrame:
    """Usability summary of the profiles — count, share with ≥ ``min_jobs`` jobs, means,
    share of specialists (> ``high``) and generalists (< ``low``)."""
    return profiles.agg(
        F.count(F.lit(1)).cast("long").alias("employees"),
        (F.avg((F.col("total_jobs") >= min_jobs).cast("double")) * 100).alias("pct_min_jobs"),
        F.avg("unique_clients").alias("mean_unique_clients"),
        F.avg("client_herfindahl").alias("mean_herfindahl"),
        F.avg("task_specialisation").alias("mean_specialisation"),
        (F.avg((F.col("task_specialisation") > high).cast("double")) * 100).alias("pct_specialists"),
        (F.avg((F.col("task_specialisation") < low).cast("double")) * 100).alias("pct_generalists"))
