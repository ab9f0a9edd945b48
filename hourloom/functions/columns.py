"""Projections and scalar expressions.

Everything here returns a ``Column`` or does a schema-level DataFrame change; no data moves, so
all of it stays inside whole-stage codegen. ANSI mode is on in Spark 4, therefore lenient parsing
goes through ``try_*`` functions (R12).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = Column | str

# Fixed value: the category that stands for a missing categorical value.
UNKNOWN = "ONBEKEND"


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ── B1-B4: schema-level projections ──────────────────────────────────────────


def select_available(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """B1: keep the wanted columns that exist, in the wanted order; report the missing ones."""
    have = set(df.columns)
    present = [c for c in wanted if c in have]
    missing = [c for c in wanted if c not in have]
    return df.select(*present), missing


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B2: rename by mapping; keys that are absent are ignored (like a tolerant rename)."""
    m = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(m) if m else df


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring missing names."""
    return df.drop(*[c for c in cols if c in df.columns])


def with_provenance(df: DataFrame, name: str, value: str) -> DataFrame:
    """Constant provenance column (``bron``/``con``)."""
    return df.withColumn(name, F.lit(value))


# ── B5-B14: derived values ───────────────────────────────────────────────────


def prior_ratio(x: ColLike, n: ColLike) -> Column:
    """``x / (n + 1)`` — share of prior events (e.g. client visits / total jobs)."""
    return _c(x).cast("double") / (_c(n).cast("double") + F.lit(1.0))


def safe_ratio(num: ColLike, den: ColLike, default: float = 1.0,
               lo: float = 0.1, hi: float = 5.0) -> Column:
    """``num/den`` with 0 denominator → NULL, NULL result → ``default``, clipped [lo, hi]."""
    r = _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
    return F.least(F.greatest(F.coalesce(r, F.lit(float(default))), F.lit(lo)), F.lit(hi))


def keep_if(cond: Column, x: ColLike) -> Column:
    """Keep ``x`` where ``cond`` holds, else NULL (pandas ``where``; NULL cond → NULL)."""
    return F.when(cond, _c(x))


def any_present(*cols: ColLike) -> Column:
    """1 when any column is non-null, else 0."""
    e = F.lit(False)
    for c in cols:
        e = e | _c(c).isNotNull()
    return e.cast("int")


def any_positive_sum(*cols: ColLike) -> Column:
    """Row-wise sum of optional columns (NULL→0) is > 0; no columns → False."""
    if not cols:
        return F.lit(False)
    s = F.lit(0.0)
    for c in cols:
        s = s + F.coalesce(_c(c).cast("double"), F.lit(0.0))
    return s > 0


def fill_unknown(df: DataFrame, categorical: Sequence[str] = (), numeric: Sequence[str] = (),
                 unknown: str = UNKNOWN) -> DataFrame:
    """Categorical NULL → ``unknown`` (as string), numeric NULL (and NaN) → 0."""
    cols = set(df.columns)
    exprs = {}
    for c in categorical:
        if c in cols:
            exprs[c] = F.coalesce(_c(c).cast("string"), F.lit(unknown))
    for c in numeric:
        if c in cols:
            exprs[c] = F.coalesce(F.nanvl(_c(c).cast("double"), F.lit(None).cast("double")),
                                  F.lit(0.0))
    return df.withColumns(exprs) if exprs else df


def lenient_double(x: ColLike) -> Column:
    """Bad values → NULL instead of an ANSI error; NaN → NULL."""
    v = _c(x).cast("string").try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def to_float32(x: ColLike) -> Column:
    """float32 output column (score is stored as float, computed in double)."""
    return _c(x).cast("float")


def composite_key(*cols: ColLike, sep: str = "__") -> Column:
    """``a__b`` string key. Callers fill NULLs first (B10); ``concat_ws`` skips NULLs."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def right_closed_bin(x: ColLike, edges: Sequence[float]) -> Column:
    """Ordinal label of the right-closed interval ``(e[i], e[i+1]]``; outside → NULL."""
    v = _c(x).cast("double")
    e = None
    for i in range(len(edges) - 1):
        cond = (v > F.lit(float(edges[i]))) & (v <= F.lit(float(edges[i + 1])))
        e = F.when(cond, F.lit(i)) if e is None else e.when(cond, F.lit(i))
    return e


def numpy_round(x: ColLike, digits: int) -> Column:
    """numpy's rounding — multiply by 10^digits, round half to even on the double
    (``rint``), divide. Same IEEE operations as ``ndarray.round``, so results match it exactly
    (e.g. 107.94999999999999 → 108.0, where ``bround`` gives 107.9)."""
    scale = F.lit(float(10 ** digits))
    return F.rint(_c(x).cast("double") * scale) / scale


def clamp_round(p: ColLike, digits: int = 2) -> Column:
    """Non-negative clamp then numpy half-even rounding."""
    return numpy_round(F.greatest(_c(p).cast("double"), F.lit(0.0)), digits)


# ── C1-C4: strings ───────────────────────────────────────────────────────────


def squeeze_upper(x: ColLike) -> Column:
    """Upper case with all spaces removed (postcode / street normalisation)."""
    return F.upper(F.replace(_c(x).cast("string"), F.lit(" "), F.lit("")))


def lower_trim(x: ColLike) -> Column:
    """Lower + strip (unit text)."""
    return F.lower(F.trim(_c(x).cast("string")))


def prefix(x: ColLike, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(x).cast("string"), 1, n)


def matches(x: ColLike, pattern: str) -> Column:
    """Regex predicate with NULL → False."""
    return F.coalesce(_c(x).cast("string").rlike(pattern), F.lit(False))


# ── D1-D5: dates ─────────────────────────────────────────────────────────────


def lenient_timestamp(x: ColLike) -> Column:
    """Parse to timestamp; unparsable → NULL (``errors='coerce'``)."""
    return F.try_to_timestamp(_c(x).cast("string"))


def weekday_mon0(d: ColLike) -> Column:
    """Day of week, Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(_c(d))


def weekday_sun0(d: ColLike) -> Column:
    """Day of week, Sunday = 0 (serving vector convention, R16)."""
    return F.dayofweek(_c(d)) - 1


def iso_week(d: ColLike) -> Column:
    """ISO-8601 week number (1..53)."""
    return F.weekofyear(_c(d))


def month_start(d: ColLike) -> Column:
    """D3: first day of the month as DATE."""
    return F.trunc(_c(d).cast("date"), "month")


# ── N1-N3: numerics ──────────────────────────────────────────────────────────


def cyclic(part: ColLike, period: float) -> tuple[Column, Column]:
    """``sin/cos(2π·part/period)``."""
    a = F.lit(2.0) * F.pi() * _c(part).cast("double") / F.lit(float(period))
    return F.sin(a), F.cos(a)


def clip(x: ColLike, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]."""
    v = _c(x).cast("double")
    if lo is not None:
        v = F.greatest(v, F.lit(float(lo)))
    if hi is not None:
        v = F.least(v, F.lit(float(hi)))
    return v


def known(x: ColLike) -> Column:
    """A number as double, NULL where it is not a number: NaN counts as missing."""
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def zero_to_null(x: ColLike) -> Column:
    """``replace(0, NaN)``."""
    return F.nullif(_c(x), F.lit(0))
