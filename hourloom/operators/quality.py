"""Data-quality reports (Q1-Q21). Each returns a tidy report DataFrame; all are single aggregate
passes (or unions of them) over the input — no driver loops over data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.columns import known
from hourloom.operators.aggregates import fill_rates, histogram
from hourloom.operators.history import overlap_flags
from hourloom.operators.relational import bounded_broadcast, exact_quantiles, union_all_by_name


def _pct(num: Column, den: Column) -> Column:
    return F.round(num * 100.0 / F.nullif(den, F.lit(0)), 2)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Put the columns of several one-row aggregates into one row without a (cross) join:
    union by name, then take each column's non-NULL value."""
    u = union_all_by_name(*one_row)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in u.columns])


def interval_check(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Q3: rows, rows with start > end (NULL bounds not judged) and their percentage."""
    bad = F.count_if(F.col(start) > F.col(end))
    return df.agg(F.count(F.lit(1)).cast("long").alias("total"), bad.cast("long").alias("violations"))\
        .select(F.lit(name).alias("check_name"), "total", "violations",
                _pct(F.col("violations"), F.col("total")).alias("pct"))


def value_checks(df: DataFrame, hours: str, amount: str, max_hours: float = 24.0) -> DataFrame:
    """Q4: negative hours, hours above ``max_hours`` and negative amounts, as report rows."""
    row = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col(hours) < 0).alias("neg_hours"),
                 F.count_if(F.col(hours) > max_hours).alias("over_max"),
                 F.count_if(F.col(amount) < 0).alias("neg_amount"))
    return row.selectExpr("total", "stack(3, 'negative_hours', neg_hours, 'hours_over_max', "
                                   "over_max, 'negative_amount', neg_amount) AS (check_name, violations)")\
        .select("check_name", F.col("total").cast("long").alias("total"),
                F.col("violations").cast("long").alias("violations"),
                _pct(F.col("violations"), F.col("total")).alias("pct"))


def names_per_tenant(df: DataFrame, tenant: str, name_cols: Sequence[str]) -> DataFrame:
    """Q6: distinct names per tenant for each naming column."""
    return df.groupBy(tenant).agg(*[F.countDistinct(c).cast("long").alias(f"distinct_{c}")
                                    for c in name_cols])


def date_health(df: DataFrame, start: str, end: str, status: str, done: Sequence,
                as_of: str) -> DataFrame:
    """Q7: date range, missing start/end, and completed items dated after ``as_of``."""
    fut = F.lit(as_of).cast("timestamp_ntz")
    return df.agg(
        F.min(start).alias("min_start"), F.max(start).alias("max_start"),
        F.count_if(F.col(start).isNull()).cast("long").alias("missing_start"),
        F.count_if(F.col(end).isNull()).cast("long").alias("missing_end"),
        F.count_if(F.col(status).isin(list(done)) & (F.col(end) > fut)).cast("long")
        .alias("future_completed"))


def overlap_summary(df: DataFrame, key: str, start: str, end: str, uid: str) -> DataFrame:
    """Q9: overlapping registrations, employees with an overlap and employees checked."""
    f = overlap_flags(df, key, start, end, uid, "__ov").where(F.col("__ov").isNotNull())
    per = f.groupBy(key).agg(F.count_if(F.col("__ov")).alias("__n"))
    return per.agg(F.sum("__n").cast("long").alias("overlapping"),
                   F.count_if(F.col("__n") > 0).cast("long").alias("employees_with_overlap"),
                   F.count(F.lit(1)).cast("long").alias("employees_checked"))


def duration_stats(df: DataFrame, col: str) -> DataFrame:
    """Q10: count, mean, std, median, P99 and rows above P99 (exact quantiles)."""
    med, p99 = exact_quantiles(df, col, [0.5, 0.99])
    v = known(col)
    return df.agg(F.count(v).cast("long").alias("n"), F.avg(v).alias("mean"),
                  F.stddev_samp(v).alias("std"), F.lit(med).alias("median"),
                  F.lit(p99).alias("p99"),
                  F.count_if(v > F.lit(p99)).cast("long").alias("above_p99"))


def duration_histogram(df: DataFrame, col: str, hi: float, bins: int) -> DataFrame:
    """Q10: histogram clipped at ``hi``."""
    return histogram(df, col, 0.0, hi, bins)


def coverage_ratio(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str
                   ) -> DataFrame:
    """Q11: distinct referenced ids / distinct parent ids (both distinct counts in one job)."""
    c = child.agg(F.countDistinct(child_col).alias("child_ids"))
    p = parent.agg(F.countDistinct(parent_col).alias("parent_ids"))
    return side_by_side(c, p).select(
        F.col("child_ids").cast("long"), F.col("parent_ids").cast("long"),
        _pct(F.col("child_ids"), F.col("parent_ids")).alias("coverage_pct"))


def monthly_volume(df: DataFrame, tenant: str, ts: str, low_share: float = 0.10) -> DataFrame:
    """Q13: rows per tenant and month, the tenant's median monthly count, and a flag for months
    below ``low_share`` of that median. The month table is small (tenants × months); the median
    per tenant is an aggregate joined back, not a tenant-wide window."""
    m = df.where(F.col(ts).isNotNull()).groupBy(
        tenant, F.trunc(F.col(ts).cast("date"), "month").alias("month"))\
        .agg(F.count(F.lit(1)).cast("long").alias("n"))
    med = m.groupBy(tenant).agg(F.percentile(F.col("n").cast("double"), 0.5).alias("median_n"))
    return m.join(bounded_broadcast(med), tenant).withColumn(
        "low_month", F.col("n") < F.lit(low_share) * F.col("median_n"))


def seasonality(df: DataFrame, ts: str) -> DataFrame:
    """Q15: counts by weekday (Monday = 0) and by calendar month, as (period, value, n)."""
    d = F.col(ts).cast("date")
    by_dow = df.groupBy(F.weekday(d).alias("value")).agg(F.count(F.lit(1)).alias("n"))\
        .withColumn("period", F.lit("weekday"))
    by_mon = df.groupBy(F.month(d).alias("value")).agg(F.count(F.lit(1)).alias("n"))\
        .withColumn("period", F.lit("month"))
    return union_all_by_name(by_dow, by_mon).select("period", F.col("value").cast("int"),
                                                    F.col("n").cast("long"))


def status_distribution(df: DataFrame, status: str, usable: Sequence) -> DataFrame:
    """Q16: count and share per status, and whether it is a usable status."""
    from pyspark.sql import Window
    c = df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    # one row per status: the total over this small table is a single-partition window by design
    c = c.withColumn("__tot", F.sum("n").over(Window.partitionBy()))
    return c.select(
        status, F.col("n").cast("long"), _pct(F.col("n"), F.col("__tot")).alias("pct"),
        F.col(status).isin(list(usable)).alias("usable"))


@dataclass
class FunnelStep:
    """One join: ``left_keys`` of the rows so far equal ``right_keys`` of ``dim``; ``carry`` are its
    columns that later steps join on. ``how`` is ``inner`` or ``left``; a left step keeps all rows
    and reports those that found a match."""

    name: str
    dim: DataFrame
    left_keys: str | Sequence[str]
    right_keys: str | Sequence[str]
    carry: Sequence[str] = ()
    how: str = "inner"


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_funnel(base: DataFrame, base_name: str, steps: Sequence[FunnelStep]) -> DataFrame:
    """Q18: rows surviving each step of a join chain, % of the start, step loss and a traffic light
    (green < 1 %, orange < 5 %, red ≥ 5 % loss).

    The chain is never joined row by row. Where each step's keys come from one table (the base or one
    dimension before), the chain is a tree: from its leaves upward every dimension is summed into the
    number of rows that a key stands for after each later step, and the base, read once, multiplies
    what its keys stand for; all steps' totals are one aggregate, and nothing is written between. A
    step whose keys come from several tables takes :func:`_totals_by_step`. NULL keys match nothing."""
    totals = _totals_by_counts(base, steps) if all(len(o) == 1 for o in _owners(steps)) else _totals_by_step(base, steps)
    names = [base_name] + [st.name for st in steps]
    long = totals.select(F.posexplode("totals").alias("step", "rows")).withColumn(
        "step_name", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("step") + 1))
    by_step = Window.orderBy("step")   # one report row per step: a single partition is fine
    long = long.withColumn("start_rows", F.first("rows").over(by_step))
    prev = F.lag("rows").over(by_step)
    loss = F.coalesce((prev - F.col("rows")) * 100.0 / F.nullif(prev, F.lit(0)), F.lit(0.0))
    return long.select(
        F.col("step").cast("int"), "step_name", F.col("rows").cast("long"),
        _pct(F.col("rows"), F.col("start_rows")).alias("pct_of_start"),
        F.round(loss, 2).alias("step_loss_pct")).withColumn(
        "light", F.when(F.col("step_loss_pct") < 1, "green")
        .when(F.col("step_loss_pct") < 5, "orange").otherwise("red"))


def _owners(steps: Sequence[FunnelStep]) -> list[set[int]]:
    """For each step the tables its keys come from: the last step before that carries the name, else the base (-1)."""
    return [{max((e for e in range(i) if k in steps[e].carry), default=-1) for k in _names(st.left_keys)}
            for i, st in enumerate(steps)]


def _totals_by_counts(base: DataFrame, steps: Sequence[FunnelStep]) -> DataFrame:
    """One row with the array ``totals``: rows at the start and after each step, by counts along the tree."""
    parent = [next(iter(o)) for o in _owners(steps)]
    children = {d: [c for c, p in enumerate(parent) if p == d] for d in range(-1, len(steps))}

    def below(d: int) -> list[int]:
        return [e for c in children[d] for e in [c, *below(c)]]

    def marks(d: int) -> list[int]:
        """The steps from which on a key of ``d`` stands for another number of rows."""
        found = {d, *below(d), *(e + 1 for e in below(d) if steps[e].how == "left")}
        return sorted(i for i in found if i < len(steps))

    def unmatched(c: int, i: int) -> int:
        """What a row without a match in left step ``c`` stands for after step ``i``."""
        if steps[c].how != "left" or i == c:
            return 0
        return int(all(unmatched(e, i) for e in children[c] if e <= i))

    def stands_for(d: int, i: int) -> Column:
        """Rows that a row of ``d`` stands for after step ``i``, from its children's counts beside it."""
        out = F.lit(1).cast("long")
        for c in children[d]:
            if c <= i:
                count = F.col(f"__m{c}_{max(m for m in marks(c) if m <= i)}")
                out = out * F.coalesce(count, F.lit(unmatched(c, i)).cast("long"))
        return out

    def with_children(df: DataFrame, d: int) -> DataFrame:
        for c in children[d]:
            on = reduce(lambda x, y: x & y, [F.col(f"`{k}`") == F.col(f"__k{c}_{j}") for j, k in enumerate(_names(steps[c].left_keys))])
            df = df.join(counts(c), on, "left")
        return df

    def wanted(d: int) -> list[str]:
        return list(dict.fromkeys(k for c in children[d] for k in _names(steps[c].left_keys)))

    def counts(d: int) -> DataFrame:
        right = _names(steps[d].right_keys)
        own = [F.col(f"`{k}`").alias(f"__k{d}_{j}") for j, k in enumerate(right)]
        rows = steps[d].dim.na.drop(subset=right).select(*own, *wanted(d))
        keys = [f"__k{d}_{j}" for j in range(len(right))]
        return with_children(rows, d).groupBy(*keys).agg(*[
            F.sum(stands_for(d, i)).cast("long").alias(f"__m{d}_{i}") for i in marks(d)])

    rows = with_children(base.select(*wanted(-1)), -1)
    after = [F.coalesce(F.sum(stands_for(-1, i)), F.lit(0)).cast("long") for i in range(len(steps))]
    return rows.agg(F.array(F.count(F.lit(1)), *after).alias("totals"))


def _totals_by_step(base: DataFrame, steps: Sequence[FunnelStep]) -> DataFrame:
    """One row with the array ``totals``, for any chain: before each step the rows are summed up to one per
    combination of the keys that later steps need, with the number of rows it stands for; a
    dimension likewise to one row per key and carried columns. A step multiplies the two numbers,
    so a key with several rows fans out into each of its carried values."""
    from hourloom.session import materialize

    def needed(after: int) -> list[str]:
        later = [k for st in steps[after:] for k in _names(st.left_keys)]
        return list(dict.fromkeys(later))

    def summed(df: DataFrame, after: int) -> DataFrame:
        made = {c for st in steps[after:] for c in st.carry}
        keys = [k for k in needed(after) if k in df.columns or k not in made]
        return df.groupBy(*keys).agg(F.sum("__n").cast("long").alias("__n"))

    start = base.select(*[c for c in needed(0) if c in base.columns]).withColumn("__n", F.lit(1).cast("long"))
    df = materialize(summed(start, 0))
    totals = [df.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("s"))]
    for i, st in enumerate(steps):
        left, right = _names(st.left_keys), _names(st.right_keys)
        d = st.dim.na.drop(subset=right).groupBy(*[F.col(k).alias(f"__k{j}") for j, k in enumerate(right)],
                                                 *[F.col(c).alias(f"__c{j}") for j, c in enumerate(st.carry)])\
            .agg(F.count(F.lit(1)).alias("__m"))
        cond = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"__k{j}") for j, k in enumerate(left)])
        keep = [F.col(c) for c in df.columns if c != "__n" and c not in st.carry]
        j = df.join(d, cond, st.how)
        j = j.select(*keep, *[F.col(f"__c{n}").alias(c) for n, c in enumerate(st.carry)],
                     (F.col("__n") * F.coalesce("__m", F.lit(1))).alias("__n"),
                     F.when(F.col("__m").isNotNull(), F.col("__n") * F.col("__m")).alias("__hit"))
        done = [k for k in needed(i + 1) if k in j.columns]
        df = materialize(j.groupBy(*done).agg(F.sum("__n").cast("long").alias("__n"),
                                              F.coalesce(F.sum("__hit"), F.lit(0)).cast("long").alias("__hit")))
        totals.append(df.agg(F.coalesce(F.sum("__hit"), F.lit(0)).cast("long").alias("s")))
        df = df.drop("__hit")
    by_step = union_all_by_name(*[t.select(F.lit(i).alias("i"), "s") for i, t in enumerate(totals)])
    return by_step.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda t: t["s"]).alias("totals"))


def feature_availability(df: DataFrame, table: str, cols: Sequence[str], good: float = 95.0,
                         usable: float = 80.0) -> DataFrame:
    """Q19/Q21: fill rate per feature with a status (≥ 95 good, ≥ 80 usable, else poor)."""
    f = fill_rates(df, table, cols)
    return f.withColumn("status", F.when(F.col("fill_pct") >= good, "good")
                        .when(F.col("fill_pct") >= usable, "usable").otherwise("poor"))


def activity_coverage(df: DataFrame, employee: str, activity: str) -> DataFrame:
    """Q20: employees per activity and activities per employee (mean, median), and the number
    and share of activities done by a single employee."""
    pairs = df.where(F.col(employee).isNotNull() & F.col(activity).isNotNull())\
        .select(employee, activity).distinct()
    from hourloom.session import materialize
    per_act = materialize(pairs.groupBy(activity).agg(F.count(F.lit(1)).alias("emps")))
    (median,) = exact_quantiles(per_act, "emps", [0.5])
    per_emp = pairs.groupBy(employee).agg(F.count(F.lit(1)).alias("acts"))
    a = per_act.agg(F.count(F.lit(1)).cast("long").alias("activities"),
                    F.avg("emps").alias("mean_employees_per_activity"),
                    F.lit(median).cast("double").alias("median_employees_per_activity"),
                    F.count_if(F.col("emps") == 1).cast("long").alias("single_employee_activities"))
    e = per_emp.agg(F.count(F.lit(1)).cast("long").alias("employees"),
                    F.avg("acts").alias("mean_activities_per_employee"))
    return side_by_side(a, e).withColumn(
        "pct_single_employee", _pct(F.col("single_employee_activities"), F.col("activities")))


def people_per_tenant(df: DataFrame, tenant: str, employee: str) -> DataFrame:
    """Q20: distinct employees per tenant, and over all tenants as the row of tenant NULL. Rows
    without a tenant count in the total only."""
    pairs = df.where(F.col(employee).isNotNull()).select(tenant, employee).distinct()
    per = pairs.where(F.col(tenant).isNotNull()).groupBy(tenant).agg(F.count(F.lit(1)).cast("long").alias("employees"))
    total = pairs.agg(F.countDistinct(employee).cast("long").alias("employees")).select(
        F.lit(None).cast(df.schema[tenant].dataType).alias(tenant), "employees")
    return per.unionByName(total)


def completeness(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1/Q12: fill rates of every column of several tables."""
    return union_all_by_name(*[fill_rates(df, t) for t, df in tables.items()])
