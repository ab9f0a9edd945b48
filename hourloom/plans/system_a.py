"""Planning system A → feature frame, composed from the operators.

Input: a dict of DataFrames named like the source tables (FIXTURES §1) plus the postcode
reference table. Output: one row per order service line with the registration's history
features, calendar features and unit amounts (reference column names).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.columns import any_positive_sum, lenient_timestamp, select_available, \
    squeeze_upper
from hourloom.functions.features import with_cyclic_calendar
from hourloom.operators.aggregates import pivot_sum, snake
from hourloom.operators.geo import first_per_key
from hourloom.operators.history import DEFAULT_SKEW_ROWS, history_features
from hourloom.operators.relational import bounded_broadcast, dedupe_keep_first, quantile_cut

# Usable order statuses, the hours unit, the unit columns of the output and the
# column selection of the feature frame.
USABLE_STATUS = [5, 7, 8, 9, 10]
HOURS_UNIT = "Uur"
UNITS = ["Baal", "Big bag", "Dag", "Hectare", "Kubieke meter", "Meter", "Milimeter", "Stuk", "Ton",
         "Uur"]
EXTRA_UNIT_COLUMNS = [
    "hoeveelheid_baal", "hoeveelheid_big_bag", "hoeveelheid_dag", "hoeveelheid_hectare",
    "hoeveelheid_kubieke_meter", "hoeveelheid_meter", "hoeveelheid_milimeter", "hoeveelheid_stuk",
    "hoeveelheid_ton",
]
BEST_COLUMNS = [
    "EmployeeId", "ServiceLineId_x", "PlanningGroupId", "EquipmentGroupId", "ClientId",
    "TenantId_x", "orderserviceline_id", "servicelinesname", "equipmentname", "EquipmentType_y",
    "EquipmentGroupTypes", "planninggroupsname", "PostalCode", "lat", "lon", "StartTime", "Datum",
    "dag_sin", "dag_cos", "maand_sin", "maand_cos", "week_sin", "week_cos", "med_gem_tijd",
    "med_std_tijd", "med_aantal_opdrachten", "med_ervaring_bewerking", "taak_gem",
    "med_klant_bezoeken", "med_klant_ratio", "med_klant_snelheid", "med_bewerking_snelheid",
    "med_klant_gem_tijd", "med_bewerking_gem_tijd", "med_totaal_opdrachten", "hoeveelheid_baal",
    "hoeveelheid_big_bag", "hoeveelheid_dag", "hoeveelheid_hectare", "hoeveelheid_kubieke_meter",
    "hoeveelheid_meter", "hoeveelheid_milimeter", "hoeveelheid_stuk", "hoeveelheid_ton",
    "heeft_extra_eenheid", "hoeveelheid_uur",
]


def _dim(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.select(key, *[c for c in cols if c in df.columns and c != key])


def denormalise(t: Mapping[str, DataFrame], bag: DataFrame) -> DataFrame:
    """The 12-step join of system A with explicit names for the colliding columns (J5):
    ``ServiceLineId_x`` (unit line), ``ServiceId_x`` (order service), ``TenantId_x`` (order),
    ``EquipmentType_y`` (equipment group). Dimension sides are broadcast after a size check;
    the line-level facts stay partitioned."""
    osl = t["OrderServiceLine"]
    os_ = t["OrderServices"].select("orderservices_id", "OrderId",
                                    F.col("ServiceId").alias("ServiceId_x"))
    df = os_.join(osl, os_.orderservices_id == osl.OrderServiceId, "right")              # J2
    o = t["Orders"].select("orders_id", "OrderStatus", "ClientId",
                           F.col("TenantId").alias("TenantId_x"), "PostalAddressId",
                           "PlanningGroupId")
    df = df.join(o, df.OrderId == o.orders_id, "left")                                   # J1
    slu = t["ServiceLineUnits"].join(bounded_broadcast(t["Units"]),
                                     F.col("UnitId") == F.col("units_id"))               # J3
    slu = slu.select(F.col("ServiceLineId").alias("ServiceLineId_x"), "UnitId", "unitsname",
                     "Amount")
    df = df.join(slu, df.orderserviceline_id == slu.ServiceLineId_x, "left")             # fan-out
    sle = t["ServiceLineEquipment"].select(F.col("ServiceLineId").alias("ServiceLineId_y"),
                                           "EquipmentId")
    df = df.join(sle, df.orderserviceline_id == sle.ServiceLineId_y, "left")
    rel = _dim(t["Relations"], "relations_id", ["ClientId"]).withColumnRenamed(
        "ClientId", "RelationClientId")
    # The tenant id is joined to the relation id (follows the reference)
    df = df.join(bounded_broadcast(rel), df.TenantId_x == rel.relations_id, "left")
    addr = t["Addresses"].withColumn("PostalCode", squeeze_upper("PostalCode"))
    pc = first_per_key(bag, "pc", ["lat", "lon"], ["pc"]).select(
        F.col("__k").alias("pc"), "__v.lat", "__v.lon")
    addr = addr.join(bounded_broadcast(pc), addr.PostalCode == pc.pc, "left").drop("pc")
    df = df.join(bounded_broadcast(_dim(addr, "addresses_id", ["PostalCode", "lat", "lon"])),
                 df.PostalAddressId == F.col("addresses_id"), "left")
    svc = t["Services"].select("services_id", F.col("RelationId").alias("svc_relation"))
    df = df.join(bounded_broadcast(svc), (df.TenantId_x == svc.svc_relation)
                 & (df.ServiceId_x == svc.services_id), "left")                          # J4
    sl = t["ServiceLines"].select("servicelines_id", "servicelinesname")
    df = df.join(bounded_broadcast(sl), df.ServiceLineId_x == sl.servicelines_id, "left")
    eq = t["Equipment"].select("equipment_id", "equipmentname",
                               F.col("EquipmentType").alias("EquipmentType_x"))
    link = t["EquipmentToEquipmentGroups"].select(F.col("EquipmentId").alias("link_eq"),
                                                  "EquipmentGroupId")
    grp = t["EquipmentGroups"].select("equipmentgroups_id", "EquipmentGroupTypes",
                                      F.col("EquipmentType").alias("EquipmentType_y"))
    eq = eq.join(link, eq.equipment_id == link.link_eq, "left").drop("link_eq")          # J8
    eq = eq.join(grp, eq.EquipmentGroupId == grp.equipmentgroups_id, "left")
    df = df.join(bounded_broadcast(eq), df.EquipmentId == eq.equipment_id, "left")
    pg = t["PlanningGroups"].select("planninggroups_id", "planninggroupsname")
    df = df.join(bounded_broadcast(pg), df.PlanningGroupId == pg.planninggroups_id, "left")
    tr = t["TimeRegistration"].select("timeregistration_id", F.col("OrderId").alias("tr_order"),
                                      F.col("EmployeeId").alias("tr_employee"),
                                      "ManHourDuration", "StartTime", "EndTime")
    df = df.join(tr, (df.OrderId == tr.tr_order) & (df.EmployeeId == tr.tr_employee), "left")
    return df.drop("tr_order", "tr_employee")


def apply_filters(df: DataFrame) -> DataFrame:
    """Lenient UTC timestamp + date, usable statuses (F1) and a time registration present (F2).
    Catalyst pushes both predicates below the joins and turns the last left join inner."""
    df = df.withColumn("StartTime", lenient_timestamp("StartTime"))\
        .withColumn("Datum", F.to_date("StartTime"))
    return df.where(F.col("OrderStatus").isin(USABLE_STATUS)
                    & F.col("timeregistration_id").isNotNull())


def add_features(df: DataFrame, skew_rows: int | None = DEFAULT_SKEW_ROWS) -> DataFrame:
    """W1-W9 per employee and per service on the registration date (their ids hold across tenants),
    then X1. Rows are at the joined
    grain (R18: one registration counts once per unit/equipment row, as in the reference); the
    tie-break is the full row identity."""
    uid = F.struct("timeregistration_id", "orderserviceline_id", "UnitId", "EquipmentId",
                   "EquipmentGroupId", "Amount")
    d = df.withColumn("__row", uid)
    f = history_features(d, tenant=None, employee="EmployeeId", client="ClientId",
                         task="ServiceId_x", date="Datum", uid="__row", hours="ManHourDuration",
                         skew_rows=skew_rows)
    return with_cyclic_calendar(f.drop("__row"), "Datum")


def pivot_units(df: DataFrame, units: Sequence[str] = UNITS) -> DataFrame:
    """G6 + G16 + B9: unit amounts per service line as columns (fixed unit list, R17), one row per
    service line from its hours-unit rows (first by time registration), plus the extra-unit
    flag."""
    pv = pivot_sum(df, ["orderserviceline_id"], "unitsname", units, "Amount")
    uur = dedupe_keep_first(df.where(F.col("unitsname") == HOURS_UNIT), ["orderserviceline_id"],
                            [F.col("timeregistration_id"), F.col("EquipmentGroupId")])
    uur = uur.drop(*[c for c in pv.columns if c != "orderserviceline_id" and c in uur.columns])
    out = uur.join(pv, "orderserviceline_id", "inner")
    extra = [c for c in EXTRA_UNIT_COLUMNS if c in out.columns]
    return out.withColumn("heeft_extra_eenheid", any_positive_sum(*extra))


def select_and_clean(df: DataFrame, q: float = 0.99) -> DataFrame:
    """B1 + F3 + F6 + F11: wanted columns, hours > 0, hours ≤ P99, extra unit present."""
    d, _ = select_available(df, BEST_COLUMNS)
    d = d.where(F.col(f"hoeveelheid_{snake(HOURS_UNIT)}") > 0)
    d = quantile_cut(d, f"hoeveelheid_{snake(HOURS_UNIT)}", q)
    return d.where(F.col("heeft_extra_eenheid"))


def prepare(tables: Mapping[str, DataFrame], bag: DataFrame,
            skew_rows: int | None = DEFAULT_SKEW_ROWS) -> DataFrame:
    """System A end to end (the reference's order: join → filter → features → pivot → clean)."""
    return select_and_clean(pivot_units(add_features(apply_filters(denormalise(tables, bag)),
                                                     skew_rows)))
