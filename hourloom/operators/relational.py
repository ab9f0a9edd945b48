"""Filters, joins, set operations, sorts/sampling and dedupe (F1-F11, J1-J12, J15-J19, U1-U3,
S1-S4, G15-G17).

Join strategy: dimension sides are broadcast only behind a row-count check
(:func:`bounded_broadcast`); above the bound the join stays a shuffle join and AQE (skew-join
splitting on) re-plans at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.functions.columns import matches
from hourloom.session import materialize

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 << 20
#: Tasks and people that a cell of the candidate grid is sized for.
CELL_TASKS, CELL_PEOPLE = 1024, 1024


# ── helpers ──────────────────────────────────────────────────────────────────


def _estimated_bytes(df: DataFrame) -> int | None:
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no JVM plan access (e.g. Connect): fall back to counting
        return None


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a join side only when its size is bounded.

    * If the optimizer's size estimate (from file sizes) is already below Spark's own broadcast
      threshold, the frame is returned as is: the planner broadcasts it without a hint or job.
    * Otherwise (typically an aggregate whose estimate is its input size) at most ``max_rows + 1``
      rows are read for their number and their width (as text, which follows strings, arrays and
      structs); the hint is set only when the rows are within ``max_rows`` and their bytes within
      ``BROADCAST_MAX_BYTES``.
    Above the bound the join stays a shuffle join and AQE re-plans at runtime (skew splitting on).
    """
    thr = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        thr_b = int(str(thr).lower().rstrip("b"))
    except ValueError:
        thr_b = 10 * 1024 * 1024
    est = _estimated_bytes(df)
    if est is not None and 0 < thr_b and est <= thr_b:
        return df
    width = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(width, F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= BROADCAST_MAX_BYTES else df


def _all_not_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))


# ── F: filters ───────────────────────────────────────────────────────────────


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """IN list."""
    return df.where(F.col(col).isin(list(values)))


def keep_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """drop rows with a NULL in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def keep_not_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """NOT IN where NULL is *kept* (pandas ``~isin``, R9)."""
    return df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def keep_matching(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """regex predicate, NULL → dropped."""
    return df.where(matches(col, pattern))


def _near_one(size: Column) -> tuple[Column, Column]:
    """``size`` moved by a power of two to where its logarithm is a normal number, and the power."""
    low, high = size < 2.0 ** -800, size > 2.0 ** 800
    return (F.when(low, size * 2.0 ** 200).when(high, size * 2.0 ** -200).otherwise(size),
            F.when(low, F.lit(-200)).when(high, F.lit(200)).otherwise(F.lit(0)))


def _key_of_size(size: Column, e: Column, m: Column) -> Column:
    """The key of an absolute value from its logarithm's floor and the fraction to it."""
    right = F.when(m < 1, F.lit(-1)).when(m >= 2, F.lit(1)).otherwise(F.lit(0))
    whole = F.when(m < 1, m * 2).when(m >= 2, m / 2).otherwise(m)
    normal = (e + right + _near_one(size)[1] + 1023) * F.lit(1 << 52) + ((whole - 1) * 2.0 ** 52).cast("long")
    return (F.when(size == float("inf"), F.lit(2047 << 52))
            .when(size < 2.0 ** -1022, (size * 2.0 ** 537 * 2.0 ** 537).cast("long")).otherwise(normal))


def order_key(v: Column) -> Column:
    """A long in the order of doubles, other for every other double (-0.0 counts as 0.0), as their IEEE
    layout has it: exponent, then fraction, the sign folded over. Every step is exact: products with
    powers of two, and a logarithm whose error of one is put right."""
    size = F.abs(v)
    near = _near_one(size)[0]
    e = F.floor(F.log2(near))
    key = _key_of_size(size, e, near * F.pow(F.lit(2.0), -e))  # the fraction is in [1, 2) but for the logarithm's error
    return F.when(v < 0, -key).otherwise(key)


def with_order_key(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with :func:`order_key` of ``value`` (0 where it is NULL), each step a column of its own: one
    expression repeats its parts some twenty times, which took ten times as long or more."""
    found = (df.withColumn("__size", F.abs(F.col(value)))
             .withColumn("__near", _near_one(F.col("__size"))[0])
             .withColumn("__exp", F.floor(F.log2("__near")))
             .withColumn("__frac", F.col("__near") * F.pow(F.lit(2.0), -F.col("__exp")))
             .withColumn("__sized", _key_of_size(F.col("__size"), F.col("__exp"), F.col("__frac"))))
    key = F.when(F.col(value) < 0, -F.col("__sized")).otherwise(F.col("__sized"))
    # never NULL, so that a join on it brings no filter, which would repeat all steps
    return found.withColumn(out, F.coalesce(key, F.lit(0).cast("long"))).drop("__size", "__near", "__exp", "__frac", "__sized")


#: Values of one group in one bin that are put in order instead of being counted on.
ORDERED = 50_000


def group_quantile_values(x: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                          interpolate: bool = True) -> DataFrame:
    """Exact linear-interpolated quantiles (``percentile`` semantics, R10) of every group: ``keys``,
    n and the array ``__q`` in the order of ``probs``; without ``interpolate`` the value at the rank below.

    Radix selection on :func:`with_order_key`: a pass counts the values of every group by the next 16 bits of
    their key, keeps the bins that hold a wanted rank, and goes on with these alone; so four passes at
    most settle any values, infinite ones included, and fewer where a bin holds one value only, or few
    enough to be put in order (``ORDERED``, a task's small window). A pass is one scan (after the first, joined to the bins wanted, a few rows per group) and one aggregate with
    partial sums: no group's values meet in one task. Values that are NULL or not a number are left
    out; so are groups without a value. Between a rank's neighbours the quantile is interpolated, so
    between a finite and an infinite value it is infinite or not a number."""
    from hourloom.session import materialize

    keys = list(keys)
    v = F.col(value).cast("double")
    x = x.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], v.alias("__v")).where(
        F.col("__v").isNotNull() & ~F.isnan("__v") & _all_not_null([f"__k{i}" for i in range(len(keys))]))
    if not keys:
        x = x.withColumn("__k0", F.lit(0))
    ks = [f"__k{i}" for i in range(max(len(keys), 1))]
    try:
        derived = "Exchange" in x._jdf.queryExecution().executedPlan().toString()
    except Exception:  # noqa: BLE001 - no JVM plan access: assume derived
        derived = True
    x = with_order_key(x, "__v", "__key")
    if derived:  # the output of an aggregate or join is written once, not made again in each pass
        x = materialize(x)
    asked = F.array(*[F.lit(float(p)) for p in probs])
    at = F.transform(asked, lambda p: p * (F.col("__n") - 1))
    ranks = F.array_distinct(F.concat(F.transform(at, lambda p: F.floor(p)), F.transform(at, lambda p: F.ceil(p))))
    met: list[DataFrame] = []
    wide = sizes = None
    for shift in (48, 32, 16, 0):
        inside, part = (x, ks) if wide is None else (
            x.withColumn("__p", F.shiftright("__key", shift + 16)).join(wide.select(*ks, "__p"), [*ks, "__p"]), [*ks, "__p"])
        held = inside.groupBy(*part, F.shiftright("__key", shift).alias("__b")).agg(
            F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__mn"), F.max("__v").alias("__mx"))
        before = Window.partitionBy(*part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # 65,536 bins at most
        cut = held.withColumn("__acc", F.coalesce(F.sum("__c").over(before), F.lit(0)))
        if wide is None:
            cut = cut.withColumn("__n", F.sum("__c").over(Window.partitionBy(*ks)))
            cut = cut.withColumn("__r", ranks.cast("array<bigint>"))
        else:
            cut = cut.join(wide, part).withColumn("__acc", F.col("__acc") + F.col("__below"))
        here = F.filter("__r", lambda r: (r >= F.col("__acc")) & (r < F.col("__acc") + F.col("__c")))
        step = materialize(cut.withColumn("__r", here).where(F.size("__r") > 0).select(
            *ks, "__n", F.col("__b").alias("__p"), F.col("__acc").alias("__below"), "__r", "__c", "__mn", "__mx"))
        sizes = step.select(*ks, "__n").distinct() if sizes is None else sizes
        met.append(step.where("__mn = __mx").select(*ks, F.explode("__r").alias("__rank"), "__mn"))
        few = step.where((F.col("__mn") < F.col("__mx")) & (F.col("__c") <= ORDERED)).select(*ks, "__p", "__below", "__r")
        held_few = x.withColumn("__p", F.shiftright("__key", shift)).join(few, [*ks, "__p"])
        nth = F.row_number().over(Window.partitionBy(*ks, "__p").orderBy("__v")) - 1 + F.col("__below")
        met.append(held_few.withColumn("__rank", nth).where(F.array_contains("__r", F.col("__rank").cast("long")))
                   .select(*ks, F.col("__rank").cast("long").alias("__rank"), F.col("__v").alias("__mn")))
        wide = step.where((F.col("__mn") < F.col("__mx")) & (F.col("__c") > ORDERED)).drop("__c", "__mn", "__mx")
        if shift and wide.isEmpty():
            break
    found = reduce(lambda p, q: p.unionByName(q), met)
    values = found.groupBy(*ks).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__mn"))).alias("__m"))

    def between(p):
        q = p * (F.col("__n") - 1)
        low, high = F.try_element_at("__m", F.floor(q).cast("long")), F.try_element_at("__m", F.ceil(q).cast("long"))
        if not interpolate:
            return low
        return F.when(low == high, low).otherwise(low + (q - F.floor(q)) * (high - low))

    out = values.join(sizes, ks).select(*ks, "__n", F.transform(asked, between).alias("__q"))
    return out.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], F.col("__n").alias("n"), "__q")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """G9/F6 scalar: exact quantiles of a column, as :func:`group_quantile_values` of one group."""
    row = group_quantile_values(df, [], col, probs).first()
    return list(row["__q"]) if row else [None] * len(probs)


def quantile_cut(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """drop rows above the global quantile ``q`` (``<=`` kept; NULL values dropped).

    The quantile is one scalar job; the filter then carries it as a literal, so the data pass is
    a plain scan + filter (no cross join, no single-partition window).
    """
    (p,) = exact_quantiles(df, col, [q])
    if p is None:
        return df.limit(0)
    return df.where(F.col(col) <= F.lit(float(p)))


def keep_large_groups(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """keep rows of groups with at least ``min_rows`` rows.

    The qualifying key set has at most ``rows / min_rows`` entries; it is semi-joined back
    (broadcast when it passes the bound check)."""
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))\
        .where(F.col("__n") >= min_rows).select(*keys)
    return df.join(bounded_broadcast(big), on=list(keys), how="left_semi")


def having_count(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], min_rows: int
                 ) -> DataFrame:
    """grouped aggregates with ``HAVING count(*) >= min_rows``."""
    return df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)


# ── J: joins ─────────────────────────────────────────────────────────────────


def lookup(df: DataFrame, dim: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
           how: str = "left", broadcast: bool = True) -> DataFrame:
    """Equi join with differing key names (composite keys allowed). One copy of each key
    survives — the preserved side's — so no ambiguous names remain (J5)."""
    cond = reduce(lambda a, b: a & b,
                  [df[lk] == dim[rk] for lk, rk in zip(left_on, right_on, strict=True)])
    d = bounded_broadcast(dim) if broadcast and how in ("left", "inner", "left_semi",
                                                        "left_anti") else dim
    out = df.join(d, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    # keep one copy of each key: the preserved side's (the right side's for a right join)
    for lk, rk in zip(left_on, right_on):
        out = out.drop(df[lk]) if how == "right" else out.drop(dim[rk])
    return out


def subtract_optional(df: DataFrame, other: DataFrame, keys: Sequence[str], value: str,
                      other_value: str, out: str) -> DataFrame:
    """Left join an optional amount and subtract it with NULL → 0."""
    j = df.join(other.select(*keys, F.col(other_value).alias("__o")), on=list(keys), how="left")
    return j.withColumn(out, F.col(value) - F.coalesce(F.col("__o"), F.lit(0.0))).drop("__o")


def bridge_join(df: DataFrame, key: str, bridge: DataFrame, bridge_left: str, bridge_right: str,
                target: DataFrame, target_key: str) -> DataFrame:
    """M:N bridge (equipment → link → group); fans out one row per link."""
    b = bridge.join(target, bridge[bridge_right] == target[target_key], "left").drop(target[target_key])
    return df.join(b, df[key] == b[bridge_left], "left").drop(b[bridge_left])


def anti_tuples(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key tuple does not occur in ``other``."""
    return df.join(other.select(*keys).distinct(), on=list(keys), how="left_anti")


def semi_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys_df`` (pandas ``isin(set)``)."""
    return df.join(bounded_broadcast(keys_df.select(*keys).distinct()), on=list(keys),
                   how="left_semi")


def orphan_check(child: DataFrame | None, child_col: str, parent: DataFrame | None,
                 parent_col: str, relation: str) -> DataFrame:
    """Distinct non-NULL child ids absent from the parent → (relation, total, violations,
    pct, status). A missing table/column is reported as a row, not raised."""
    spark = SparkSession.active() if child is None and parent is None else (child or parent).sparkSession
    schema = "relation string, total_ids long, violations long, pct double, status string"
    if child is None or parent is None or child_col not in child.columns \
            or parent_col not in parent.columns:
        return spark.createDataFrame([(relation, None, None, None, "missing column")], schema)
    ids = child.select(F.col(child_col).alias("__id")).where(F.col("__id").isNotNull()).distinct()
    par = parent.select(F.col(parent_col).alias("__id")).where(F.col("__id").isNotNull()).distinct()
    flagged = ids.join(par.withColumn("__hit", F.lit(True)), "__id", "left")
    return flagged.agg(
        F.count(F.lit(1)).cast("long").alias("total_ids"),
        F.count_if(F.col("__hit").isNull()).cast("long").alias("violations"),
    ).select(F.lit(relation).alias("relation"), "total_ids", "violations",
             F.round(F.col("violations") * 100.0 / F.nullif(F.col("total_ids"), F.lit(0)), 2)
             .alias("pct"),
             F.lit("ok").alias("status"))


def missing_months(df: DataFrame, group: str, ts: str) -> DataFrame:
    """Months between a group's first and last month with no rows."""
    m = df.where(F.col(group).isNotNull() & F.col(ts).isNotNull())\
        .select(group, F.trunc(F.col(ts).cast("date"), "month").alias("month"))
    present = m.distinct()
    rng = m.groupBy(group).agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    expected = rng.select(group, F.explode(F.sequence("lo", "hi", F.expr("interval 1 month")))
                          .alias("month"))
    return expected.join(present, [group, "month"], "left_anti")


def candidate_cells(tasks: DataFrame, people: DataFrame, tenant: str, cell_tasks: int = CELL_TASKS,
                    cell_people: int = CELL_PEOPLE) -> DataFrame:
    """J15 in cells: each task x every person of its tenant, with the cell (``__row``, ``__col``) of the pair.

    A tenant is a grid of ceil(tasks / ``cell_tasks``) rows and ceil(people / ``cell_people``) columns. A task
    has one row, by its hash, and is copied to all columns; a person has one column and is copied to all
    rows. They meet by an equi-join on (tenant, row, column), so each pair meets once, in a cell of about
    ``cell_tasks`` x ``cell_people`` pairs however large the tenant is: no side needs a broadcast and no key is
    hot. Rows that repeat another row share its cell. NULL tenants match nothing.
    """
    def ceil_div(n: str, size: int) -> Column:
        return F.ceil(F.col(n) / F.lit(size)).cast("int")

    sizes = tasks.groupBy(tenant).agg(F.count(F.lit(1)).alias("__nt")).join(
        people.groupBy(tenant).agg(F.count(F.lit(1)).alias("__np")), tenant)
    grid = bounded_broadcast(materialize(sizes.select(  # a row per tenant
        tenant, ceil_div("__nt", cell_tasks).alias("__rows"), ceil_div("__np", cell_people).alias("__cols"))))

    def dealt(df: DataFrame, own: str, own_n: str, copied: str, copied_n: str) -> DataFrame:
        at = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col(own_n)).cast("int")
        return df.join(grid, tenant).withColumn(own, at).withColumn(
            copied, F.explode(F.sequence(F.lit(0), F.col(copied_n) - 1))).drop("__rows", "__cols")

    return dealt(people, "__col", "__cols", "__row", "__rows").join(
        dealt(tasks, "__row", "__rows", "__col", "__cols"), [tenant, "__row", "__col"])


def expand_candidates(tasks: DataFrame, people: DataFrame, tenant: str) -> DataFrame:
    """Each task x every person of its tenant, through :func:`candidate_cells`. The output size is
    tasks x people per tenant by definition; where only the best are wanted, take :func:`top_candidates`."""
    return candidate_cells(tasks, people, tenant).drop("__row", "__col")


def top_candidates(tasks: DataFrame, people: DataFrame, tenant: str, task_id: str, person: str, score: Column,
                   k: int = 3, cell_tasks: int = CELL_TASKS, cell_people: int = CELL_PEOPLE) -> DataFrame:
    """J15 + W11: per task its ``k`` best people of the tenant by ``score`` (a Column over the columns of both),
    ties by person, with ``score`` and ``rank`` from 1; NULL scores come last.

    Each cell keeps the ``k`` best per task before anything moves (its rows are already together), so at most
    k rows per task and column are shuffled to be merged. ``task_id`` is unique.
    """
    pairs = candidate_cells(tasks, people, tenant, cell_tasks, cell_people).withColumn("score", score)
    best = [F.col("score").desc_nulls_last(), F.col(person)]
    in_cell = Window.partitionBy(tenant, "__row", "__col", task_id).orderBy(*best)
    few = pairs.withColumn("__in_cell", F.row_number().over(in_cell)).where(F.col("__in_cell") <= k)
    merged = Window.partitionBy(task_id).orderBy(*best)
    return few.drop("__row", "__col", "__in_cell").withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k)


def join_back(detail: DataFrame, agg: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a per-key aggregate to every detail row."""
    return detail.join(agg, on=list(keys), how="left")


# ── U, S, G15-G17 ────────────────────────────────────────────────────────────


def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by name, missing columns → NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rk") -> DataFrame:
    """First ``k`` rows per group by ``order`` (Spark plans a WindowGroupLimit before the
    shuffle, so only k rows per group and partition are exchanged)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Deterministic uniform sample of ``n`` rows without replacement — the ``n`` smallest
    multiplicative hashes ``((key mod 2^31)·2654435761 + seed) mod 2^32`` of the unique key.

    Independent of partitioning (unlike ``randomSplit``/``sample``); the sort is a top-n
    (TakeOrderedAndProject), so only ``n`` rows per task move. The hash is plain integer arithmetic,
    so other engines reproduce the same sample."""
    h = F.pmod(F.pmod(F.col(key).cast("long"), F.lit(2 ** 31)) * F.lit(2654435761)
               + F.lit(seed), F.lit(2 ** 32))
    return df.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows involved in duplicates (``keep=False``) → one row (dup_groups, dup_rows)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return g.agg(F.count(F.lit(1)).cast("long").alias("dup_groups"),
                 F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("dup_rows"))


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """F8: inclusive range."""
    return df.where(F.col(col).between(lo, hi))
