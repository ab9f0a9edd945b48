"""Row-level feature expressions: cyclic calendar encoding (X1) and quantity buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.columns import any_present, cyclic, iso_week, keep_if, lower_trim, \
    weekday_mon0

# Fixed values (must equal the reference for the same features):
# unit texts (after lower + strip) per quantity bucket, system B script variant.
VOLUME_UNITS = ["m3", "m3.", "ltr", "ltr."]
WEIGHT_UNITS = ["ton", "kg"]
PIECE_UNITS = ["stuk", "st.", "st", "pak", "baal", "rol", "keer", "kr."]
# notebook variant adds a hectare bucket on the raw (not normalised) text
HECTARE_UNITS = ["ha"]


def with_cyclic_calendar(df: DataFrame, date_col: str, prefix_day: str = "dag",
                         prefix_month: str = "maand", prefix_week: str = "week",
                         week_col: str | None = None) -> DataFrame:
    """Day (Monday = 0, /7), month (/12) and ISO week (/52, week 53 kept, R15) as sin/cos.

    ``week_col`` uses a stored week number instead of the date's ISO week (notebook variant).
    """
    d = F.col(date_col).cast("date")
    day_s, day_c = cyclic(weekday_mon0(d), 7)
    mon_s, mon_c = cyclic(F.month(d), 12)
    wk = F.col(week_col) if week_col else iso_week(d)
    wk_s, wk_c = cyclic(wk, 52)
    return df.withColumns({
        f"{prefix_day}_sin": day_s, f"{prefix_day}_cos": day_c,
        f"{prefix_month}_sin": mon_s, f"{prefix_month}_cos": mon_c,
        f"{prefix_week}_sin": wk_s, f"{prefix_week}_cos": wk_c,
    })


def with_quantity_buckets(df: DataFrame, unit_col: str, amount_col: str,
                          normalise: bool = True, with_hectare: bool = False,
                          volume=VOLUME_UNITS, weight=WEIGHT_UNITS, pieces=PIECE_UNITS,
                          hectare=HECTARE_UNITS) -> DataFrame:
    """Split an amount into volume / weight / pieces (+ hectare) by unit text, plus a 0/1
    presence flag. When the unit or amount column is missing, buckets are NULL and the flag 0.
    """
    names = ["hoeveelheid_volume", "hoeveelheid_gewicht", "hoeveelheid_stuks"]
    if with_hectare:
        names.append("hoeveelheid_hectare")
    if unit_col not in df.columns or amount_col not in df.columns:
        return df.withColumns({**{n: F.lit(None).cast("double") for n in names},
                               "hoeveelheid_aanwezig": F.lit(0)})
    u: Column = lower_trim(unit_col) if normalise else F.col(unit_col)
    amt = F.col(amount_col).cast("double")
    out = {
        "hoeveelheid_volume": keep_if(u.isin(list(volume)), amt),
        "hoeveelheid_gewicht": keep_if(u.isin(list(weight)), amt),
        "hoeveelheid_stuks": keep_if(u.isin(list(pieces)), amt),
    }
    if with_hectare:
        out["hoeveelheid_hectare"] = keep_if(u.isin(list(hectare)), amt)
    out["hoeveelheid_aanwezig"] = any_present(*out.values())
    return df.withColumns(out)
