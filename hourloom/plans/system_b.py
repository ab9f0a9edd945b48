"""Planning system B (N tenant databases) → feature frame, composed from the
operators. Table names follow FIXTURES §2; every table already carries the tenant column ``con``
(see :func:`hourloom.sources.tables.union_sources`)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.columns import lenient_timestamp, matches, prefix, squeeze_upper
from hourloom.functions.features import with_cyclic_calendar, with_quantity_buckets
from hourloom.operators.aggregates import net_work_time
from hourloom.operators.geo import LookupLevel, lookup_cascade
from hourloom.operators.history import DEFAULT_SKEW_ROWS, history_features
from hourloom.operators.relational import bounded_broadcast, keep_large_groups, keep_not_in

# Work time kinds, the Netherlands country id, street values that are not streets,
# the postcode pattern and the minimum rows per tenant.
WORK_KINDS = [1, 3]
COUNTRY_NL = 3
NOT_A_STREET = ["POSBUS", "POSTBUS", "P.O.BOX", ""]
POSTCODE_PATTERN = r"^\d{4}[A-Z]{2}$"
MIN_TENANT_ROWS = 1000
KEYS = ["con", "URENVERANTW_MEDID", "URENVERANTW_ORDDAID", "URENVERANTW_DATUM"]


def work_time(t: Mapping[str, DataFrame]) -> DataFrame:
    """G2 (+J4, J6): net worked hours per (tenant, employee, activity, day) from the time
    accounting rows and the time-kind break flag."""
    u = t["TB_URENVERANTWOORDING"]
    tk = t["TB_TIJDSOORT"].select("con", "TIJDSOORT_ID", "TIJDSOORT_ONDERBREKING")
    u = u.join(bounded_broadcast(tk), ["TIJDSOORT_ID", "con"], "left")
    u = u.withColumn("URENVERANTW_DATUM",
                     F.to_date(lenient_timestamp(F.col("URENVERANTW_DATUM"))))
    return net_work_time(u, KEYS, "URENVERANTW_TIJDSOORT", "URENVERANTW_AANTAL",
                         "TIJDSOORT_ONDERBREKING", work_kinds=WORK_KINDS,
                         date="URENVERANTW_DATUM", activity="URENVERANTW_ORDDAID")


def merge_dimensions(wt: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Activity → service article → order line (+unit, fans out as in the script) → order
    → machine, all left joins on (tenant, id)."""
    da = t["TB_ORDER_DA"].select("con", F.col("ORDER_DA_ID").alias("URENVERANTW_ORDDAID"),
                                 "ORDER_DA_ID", "ORD_ID", "DIENST_ART_ID")
    df = wt.join(da, ["con", "URENVERANTW_ORDDAID"], "left")
    art = t["TB_DIENST_ARTIKEL"].select("con", "DIENST_ART_ID", "DIENST_ART_OMS")
    df = df.join(bounded_broadcast(art), ["con", "DIENST_ART_ID"], "left")
    unit = t["TB_EENHEID"].select("con", "EENHEID_ID", "EENHEID_OMS")
    lines = t["TB_ORDERREGEL"].select("con", "ORDER_DA_ID", "ORDRG_ID", "EENHEID_ID",
                                      "ORDRG_HOEVEELHEID")
    lines = lines.join(bounded_broadcast(unit), ["con", "EENHEID_ID"], "left")
    df = df.join(lines, ["con", "ORDER_DA_ID"], "left")
    order = t["TB_ORDER"].select("con", "ORD_ID", "RELATIE_ID", "BEWERKING_ID")
    df = df.join(order, ["con", "ORD_ID"], "left")
    mach = t["TB_MACHINE"].select("con", F.col("MACH_DEF_DA_ID").alias("DIENST_ART_ID"),
                                  "MACH_OMS")
    return df.join(bounded_broadcast(mach), ["con", "DIENST_ART_ID"], "left")


def geocode(relatie: DataFrame, bag: DataFrame) -> DataFrame:
    """Client address → (lat, lon) by exact postcode, then street, then the postcode's first
    four characters; Dutch, complete addresses only, post-office boxes excluded; one row per
    (tenant, client)."""
    r = relatie.na.drop(subset=["REL_HUISNUMMER", "REL_STRAAT", "REL_POSTCODE"])\
        .where(F.col("LAND_ID") == COUNTRY_NL)\
        .withColumns({"REL_POSTCODE": squeeze_upper("REL_POSTCODE"),
                      "REL_STRAAT": squeeze_upper("REL_STRAAT")})
    r = keep_not_in(r, "REL_STRAAT", NOT_A_STREET)
    streets = bag.withColumn("straat", squeeze_upper("straat"))
    pc4 = bag.withColumn("pc4", prefix("pc", 4))
    order = ["pc", "straat", "hnr"]
    levels = [
        LookupLevel("postcode", F.col("REL_POSTCODE"), bag, "pc", ["lat", "lon"], order,
                    eligible=matches("REL_POSTCODE", POSTCODE_PATTERN)),
        LookupLevel("street", F.col("REL_STRAAT"), streets, "straat", ["lat", "lon"], order),
        LookupLevel("pc4", prefix("REL_POSTCODE", 4), pc4, "pc4", ["lat", "lon"], order),
    ]
    g = lookup_cascade(r, levels, ["con", "RELATIE_ID"], ["REL_POSTCODE", "REL_STRAAT"],
                       ["lat", "lon"])
    return g.select("con", "RELATIE_ID", "REL_POSTCODE", "lat", "lon").na.drop(
        subset=["lat", "lon"])


def prepare(t: Mapping[str, DataFrame], bag: DataFrame, min_tenant_rows: int = MIN_TENANT_ROWS,
            skew_rows: int | None = DEFAULT_SKEW_ROWS) -> DataFrame:
    """System B end to end: net work time → dimensions → geocoded clients → history, calendar
    and quantity features → tenants with enough rows → rows with coordinates. Registrations at
    clients without coordinates count in the history and in the tenant's rows; they leave last."""
    df = merge_dimensions(work_time(t), t)
    df = df.join(geocode(t["TB_RELATIE"], bag), ["con", "RELATIE_ID"], "left")
    uid = F.struct("URENVERANTW_ORDDAID", "ORDRG_ID", "con", "URENVERANTW_MEDID", "URENVERANTW_DATUM",
                   "MACH_OMS")
    df = history_features(df.withColumn("__row", uid), tenant="con",
                          employee="URENVERANTW_MEDID", client="RELATIE_ID",
                          task="DIENST_ART_ID", date="URENVERANTW_DATUM", uid="__row",
                          hours="REAL_WORKED_TIME", skew_rows=skew_rows).drop("__row")
    df = with_cyclic_calendar(df, "URENVERANTW_DATUM")
    df = with_quantity_buckets(df, "EENHEID_OMS", "ORDRG_HOEVEELHEID")
    df = keep_large_groups(df, ["con"], min_tenant_rows)
    return df.na.drop(subset=["lat", "lon"])
