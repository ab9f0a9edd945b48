"""Aggregations.

All of them are hash aggregates with a partial (map-side) phase, so a hot group is pre-combined
in every task before the shuffle. Exact quantiles use ``percentile`` (linear interpolation, R10),
never ``approx_percentile``/``summary``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.columns import known
from hourloom.operators.relational import bounded_broadcast, exact_quantiles, group_quantile_values


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """G1: group sum; NULL keys dropped (R7), all-NULL sum → 0."""
    return (df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.coalesce(F.sum(known(value)), F.lit(0.0)).alias(out)))


def net_work_time(df: DataFrame, keys: Sequence[str], kind: str, hours: str, break_flag: str,
                  work_kinds: Sequence = (1, 3), date: str | None = None,
                  min_date: str | None = "2000-01-01", activity: str | None = None,
                  q: float = 0.99) -> DataFrame:
    """Net work time = Σ work hours − Σ break hours per group, kept when > 0 and ≤ P99.

    One pass: both sums are conditional aggregates of the same ``groupBy`` (no second aggregate
    and no join back). Work rows: ``kind`` in ``work_kinds``; break rows: ``kind`` not a work
    kind and ``break_flag`` true. Only groups with at least one work row are kept (the reference
    left-joins breaks onto work groups). Input cleaning as in the reference: date ≥ ``min_date``,
    hours ≥ 0, activity ≠ 0 with NULL activity kept (R9).
    """
    d = df
    if date and min_date:
        d = d.where(F.col(date) >= F.lit(min_date).cast("date"))
    d = d.where(F.col(hours) >= 0)
    if activity:
        d = d.where((F.col(activity) != 0) | F.col(activity).isNull())
    d = d.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    is_work = F.coalesce(F.col(kind).isin(list(work_kinds)), F.lit(False))
    is_break = ~is_work & F.coalesce(F.col(break_flag), F.lit(False))  # a NULL kind is no work kind (R9)
    g = d.groupBy(*keys).agg(
        F.sum(F.when(is_work, known(hours))).alias("WERK_TIME"),
        F.coalesce(F.sum(F.when(is_break, known(hours))), F.lit(0.0)).alias("PAUSE_TIME"),
        F.count_if(is_work).alias("__nwork"),
    ).where(F.col("__nwork") > 0).drop("__nwork")
    g = g.withColumn("REAL_WORKED_TIME", F.col("WERK_TIME") - F.col("PAUSE_TIME"))
    # the aggregate is read twice (quantile, then the cut): write it once to the shared folder
    from hourloom.session import materialize
    g = materialize(g)
    (p,) = exact_quantiles(g, "REAL_WORKED_TIME", [q])
    if p is None:
        return g.limit(0)
    return g.where((F.col("REAL_WORKED_TIME") > 0) & (F.col("REAL_WORKED_TIME") <= F.lit(p)))


def snake(v: str) -> str:
    """C4: column-name form of a value — lower case, spaces → underscores (reference naming)."""
    return re.sub(r"\s", "_", str(v).lower())


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
              amount: str, prefix: str = "hoeveelheid_", other: str = "overig") -> DataFrame:
    """Pivot-sum with a fixed value list (stable schema, R17), NULL → 0 and snake-case names.
    Amounts of any other value (NULL too) go to the column ``other``, so none is lost.

    Written as conditional sums in one aggregate — what ``pivot`` expands to — so values absent
    from the data still produce a 0 column."""
    aggs = [F.coalesce(F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(amount))), F.lit(0.0))
            .alias(f"{prefix}{snake(v)}") for v in values]
    rest = ~F.coalesce(F.col(pivot_col).isin(list(values)), F.lit(False))
    aggs.append(F.coalesce(F.sum(F.when(rest, F.col(amount))), F.lit(0.0)).alias(f"{prefix}{other}"))
    return df.groupBy(*keys).agg(*aggs)


def pivot_count(df: DataFrame, row: str, col: str, values: Sequence, other: str = "other") -> DataFrame:
    """Counts of ``row`` × ``col`` for a fixed list of column values (0 when absent); rows with
    any other value (NULL too) count in the column ``other``."""
    aggs = [F.count_if(F.col(col) == F.lit(v)).cast("long").alias(str(v)) for v in values]
    aggs.append(F.count_if(~F.coalesce(F.col(col).isin(list(values)), F.lit(False))).cast("long").alias(other))
    return df.groupBy(row).agg(*aggs)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Value counts, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("n"))\
        .orderBy(F.col("n").desc(), F.col(col))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float] = (0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """Exact quantiles per group, one column per probability (``q25``, ``q50``, ...)."""
    g = group_quantile_values(df, keys, value, probs)
    return g.select(*keys, *[F.col("__q")[i].alias(f"q{round(p * 100):02d}")
                             for i, p in enumerate(probs)])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, 25/50/75 %, max per column — exact quantiles (``summary``
    uses approximate ones); one report row per column. The columns are unpivoted and handled
    together: one scan for the moments, and for the quartiles as many as the narrowing takes,
    however many columns there are."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), known(c).alias("x")) for c in cols])))
    m = long.groupBy("column_name").agg(
        F.count("x").cast("double").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    q = group_quantile_values(long, ["column_name"], "x", [0.25, 0.5, 0.75])
    return m.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", F.col("__q")[0].alias("25%"), F.col("__q")[1].alias("50%"),
        F.col("__q")[2].alias("75%"), "max")


def group_max_normalise(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``value / max(value)`` within the group; 0 when the group max is ≤ 0 or NULL. Values that are
    not a number have no part in the maximum, and no result.

    The per-group max is a tiny aggregate (one row per group) joined back — broadcast after a
    size check — not a group-wide window, which would put a big tenant into one task."""
    mx = df.groupBy(group).agg(F.max(known(value)).alias("__mx"))
    j = df.join(bounded_broadcast(mx), on=group, how="left")
    return j.withColumn(out, F.when(F.col("__mx") > 0, known(value) / F.col("__mx"))
                        .otherwise(F.lit(0.0))).drop("__mx")


def concentration(df: DataFrame, entity: str, item: str) -> DataFrame:
    """Per entity, counts per item → Herfindahl index Σ share², specialisation
    max(n)/Σn, distinct items and total rows."""
    c = df.where(F.col(entity).isNotNull() & F.col(item).isNotNull())\
        .groupBy(entity, item).agg(F.count(F.lit(1)).alias("__n"))
    tot = F.sum("__n")
    return c.groupBy(entity).agg(
        (F.sum(F.col("__n") * F.col("__n")) / (tot * tot)).alias("herfindahl"),
        (F.max("__n") / tot).alias("specialisation"),
        F.count(F.lit(1)).cast("long").alias("unique_items"),
        tot.cast("long").alias("total_rows"))


def sorted_set(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Sorted distinct values per group."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_set(col)).alias(out))


def zscore_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame of mean and sample std (std 0 or NULL → 1) per column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(known(c)).alias(f"{c}__mean"),
                 F.coalesce(F.nullif(F.stddev_samp(known(c)), F.lit(0.0)), F.lit(1.0)).alias(f"{c}__std")]
    return df.agg(*aggs)


def apply_zscore(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale with (train-set) stats. The stats frame is one row (two scalars per column), so
    it is read once and applied as literals — no join at all."""
    row = stats.first()
    return df.withColumns({c: (F.col(c) - F.lit(row[f"{c}__mean"])) / F.lit(row[f"{c}__std"])
                           for c in cols})


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width histogram on [lo, hi] after clipping values into the range; a bin without
    values has a count of 0. NULL and NaN are left out, infinite values are clipped like others."""
    x = F.least(F.greatest(known(col), F.lit(lo)), F.lit(hi))
    b = F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
    found = df.where(known(col).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).cast("long").alias("found"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(found, "bin", "left").select("bin", F.coalesce("found", F.lit(0)).cast("long").alias("n")).select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit((hi - lo) / bins)).alias("bin_start"), "n")


def five_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Min, q1, median, q3, max and n per group (box-plot data), as exact quantiles of 0, 1/4,
    1/2, 3/4 and 1."""
    q = group_quantile_values(df, keys, value, [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.select(*keys, F.col("__q")[0].cast(df.schema[value].dataType).alias("min"),
                    F.col("__q")[1].alias("q1"), F.col("__q")[2].alias("median"), F.col("__q")[3].alias("q3"),
                    F.col("__q")[4].cast(df.schema[value].dataType).alias("max"), F.col("n").cast("long").alias("n"))


def merge_duplicates(df: DataFrame, keys: Sequence[str], uid: str, hours: str,
                     attrs: Sequence[str]) -> DataFrame:
    """One row per key — attributes of the first row (lowest ``uid``), hours summed.

    ``min_by`` is a partial aggregate, so a key with many copies is pre-combined per task."""
    first = F.min_by(F.struct(*[F.col(a) for a in attrs]), F.col(uid)).alias("__first")
    return df.groupBy(*keys).agg(first, F.min(uid).alias(uid),
                                 F.sum(hours).alias(hours),
                                 F.count(F.lit(1)).cast("long").alias("merged_rows"))\
        .select(*keys, uid, *[F.col(f"__first.{a}").alias(a) for a in attrs], hours,
                "merged_rows")


def fill_rates(df: DataFrame, table: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-NULL share per column as (table, column, non_null, rows, fill_pct).

    One aggregate over all columns, then ``stack`` to long form."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("__rows", f"stack({len(cols)}, {pairs}) AS (column_name, non_null)")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.col("non_null").cast("long").alias("non_null"),
                       F.col("__rows").cast("long").alias("rows"),
                       F.round(F.col("non_null") * 100.0 / F.nullif(F.col("__rows"), F.lit(0)), 2)
                       .alias("fill_pct"))


def share(cond: Column) -> Column:
    """Percentage of rows meeting a condition (NULL counts as not meeting)."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("double")) * F.lit(100.0)


def range_report(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Min, max, NULL count and count after ``as_of`` (D4: the reference compares to the
    current time; a parameter keeps runs deterministic)."""
    t = F.col(ts)
    as_of_lit = F.lit(as_of).cast(df.schema[ts].dataType)   # same type: no zone conversion
    return df.agg(F.min(t).alias("min_ts"), F.max(t).alias("max_ts"),
                  F.count_if(t.isNull()).cast("long").alias("null_ts"),
                  F.count_if(t > as_of_lit).cast("long").alias("future_ts"))
