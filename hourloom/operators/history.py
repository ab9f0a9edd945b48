"""Leak-free history features over ordered event histories.

Every statistic for a row uses only rows that come *strictly before* it in the per-key order
``(date, unique id)`` (R3, R4), so the first row of a group is NULL (R1, the evident intent of the
reference's ``expanding().mean().shift(1)``; the reference itself leaks the previous group's value
into that row — documented deviation). Rows with a NULL key get NULL outputs (R7).
A value that is not a number counts as missing.

Execution
---------
*Cold keys* use plain window functions over ``rowsBetween(unboundedPreceding, -1)``; Spark evaluates
such a frame incrementally in one pass over the sorted key group. Rows with NULL keys are spread
over many window partitions by a hash salt (their outputs are NULL anyway), so a NULL-heavy key
column never lands in one task.

*Hot keys* — a key holding more than ``skew_rows`` rows, e.g. one employee with a third of all
registrations — would put that whole history into a single task. All rows are range-partitioned on the
order once into contiguous, equally sized chunks (the chunk id is the range partition id, written to the
shared folder so every later step and key set sees the same chunks). A hot key's rows of a chunk have their
own running statistics, the totals of (hot key, chunk) are prefix-summed over a small table, and both parts
are combined exactly: counts add, means combine by weight and the second moment by Chan's parallel-variance
formula around a per-key pivot. Cold keys of the same key set have one window each in the same pass. The
result equals the direct window up to floating-point rounding.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.columns import known
from hourloom.session import materialize

DEFAULT_SKEW_ROWS = 5_000_000
_SALT_BUCKETS = 256
#: Below ``CHUNKS`` chunks their rows follow ``skew_rows``; above, a chunk has ``CHUNK_ROWS`` rows or more.
CHUNKS, CHUNK_ROWS = 64, 250_000
CHUNK = "__chunk"


def _chunk_count(hot_rows: int, skew_rows: int) -> int:
    """Range chunks for ``hot_rows`` rows that are cut together: two for each ``skew_rows`` rows, but not
    so many that tasks and files of a few rows take the time (many keys just above a low bound)."""
    return max(2, min(math.ceil(hot_rows / skew_rows) * 2, max(CHUNKS, math.ceil(hot_rows / CHUNK_ROWS))))


def _any_null(keys: Sequence[str]) -> Column:
    e = F.lit(False)
    for k in keys:
        e = e | F.col(k).isNull()
    return e


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def _null_salt(keys: Sequence[str], order: Sequence[str]) -> Column:
    return F.when(_any_null(keys), F.pmod(F.xxhash64(*[F.col(c) for c in order]),
                                          F.lit(_SALT_BUCKETS))).otherwise(F.lit(0))


def find_hot_keys(df: DataFrame, keys: Sequence[str], skew_rows: int) -> tuple[DataFrame, int, int]:
    """Keys holding more than ``skew_rows`` rows, materialised, plus their count and row total.

    The result has at most ``rows / skew_rows`` entries and is read from where it is written, so
    Spark knows its size and broadcasts it below its threshold only.
    When the whole input has at most ``skew_rows`` rows no key can be hot and only that count runs.
    """
    if df.count() <= skew_rows:
        return df.sparkSession.createDataFrame([], df.select(*keys).schema.add("__rows", "long")), 0, 0
    counts = (df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
              .where(F.col("__rows") > F.lit(skew_rows)))
    hot = materialize(counts)
    stats = hot.agg(F.count(F.lit(1)).alias("n"), F.sum("__rows").alias("r")).first()
    return hot, int(stats["n"] or 0), int(stats["r"] or 0)


def hot_key_sets(df: DataFrame, key_sets: Sequence[Sequence[str]], skew_rows: int
                 ) -> dict[tuple[str, ...], DataFrame]:
    """The keys above ``skew_rows`` rows (with ``__rows``) of each key set that has any — one
    grouping-sets aggregation (one scan, partial aggregation before the shuffle) for all sets, its
    at most rows / ``skew_rows`` rows per set written once."""
    if df.count() <= skew_rows:            # no key can exceed the bound
        return {}
    cols = sorted({c for ks in key_sets for c in ks})
    g = df.groupingSets([[F.col(c) for c in ks] for ks in key_sets], *[F.col(c) for c in cols])\
        .agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid"))
    g = materialize(g.where(F.col("__n") > F.lit(skew_rows)))
    found = {tuple(ks): g.where(_set_cond(ks, cols, skew_rows)).select(*ks, F.col("__n").alias("__rows"))
             for ks in key_sets}
    return {ks: hot for ks, hot in found.items() if not hot.isEmpty()}


def _set_cond(ks, cols, skew_rows) -> Column:
    # grouping_id bit i is 1 when cols[i] is aggregated away (not in the set)
    gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in ks)
    cond = (F.col("__gid") == gid) & (F.col("__n") > skew_rows)
    for k in ks:
        cond = cond & F.col(k).isNotNull()
    return cond


def _direct(df: DataFrame, keys, order, value, names: dict, salt_col: str | None = None
            ) -> DataFrame:
    """Plain windows. ``salt_col`` reuses an existing salt column (built on a key prefix), so
    nested key sets (employee ⊂ employee+task) share one hash partitioning and one exchange."""
    salt = salt_col or "__salt"
    d = df if salt_col else df.withColumn(salt, _null_salt(keys, order))
    base = Window.partitionBy(*keys, salt).orderBy(*_order_cols(order))
    prior = base.rowsBetween(Window.unboundedPreceding, -1)
    valid = ~_any_null(keys)
    exprs = {}
    v = known(value) if value else None
    if "mean" in names:
        exprs[names["mean"]] = F.when(valid, F.avg(v).over(prior))
    if "std" in names:
        exprs[names["std"]] = F.when(valid, F.stddev_samp(v).over(prior))
    if "count" in names:
        exprs[names["count"]] = F.when(valid, F.count(v).over(prior))
    if "cumcount" in names:
        exprs[names["cumcount"]] = F.when(valid, F.row_number().over(base) - F.lit(1))
    out = d.withColumns(exprs)
    return out if salt_col else out.drop(salt)


def _chunked(df: DataFrame, ranged: DataFrame, keys, order, value, names: dict, hot: DataFrame) -> DataFrame:
    """Exact prior statistics: keys in ``hot`` from windows over their rows of a chunk and a prefix over chunk
    totals, other keys from one window each. Rows of ``df`` have the chunk that they have in ``ranged``."""
    ch, cols = "__part", df.columns
    hot_keys = hot.select(*keys)
    df = df.join(hot_keys.withColumn("__hot", F.lit(True)), on=keys, how="left").withColumn(
        ch, F.when(F.col("__hot"), F.col(CHUNK)).otherwise((F.lit(-1) - _null_salt(keys, order)).cast("int"))).drop("__hot")
    ranged = ranged.join(hot_keys, on=keys, how="left_semi").withColumnRenamed(CHUNK, ch)
    v = known(value) if value else F.lit(None).cast("double")
    base = Window.partitionBy(*keys, ch).orderBy(*_order_cols(order))
    prior = base.rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({
        "__n_l": F.count(v).over(prior),
        "__mean_l": F.avg(v).over(prior),
        "__var_l": F.var_samp(v).over(prior),
        "__rn_l": F.row_number().over(base) - F.lit(1),
    })
    cs = ranged.groupBy(*keys, ch).agg(
        F.count(v).alias("__n_c"), F.avg(v).alias("__mean_c"),
        (F.coalesce(F.var_samp(v), F.lit(0.0)) * (F.count(v) - F.lit(1))).alias("__m2_c"),
        F.count(F.lit(1)).alias("__rows_c"))
    wall = Window.partitionBy(*keys)
    wprev = Window.partitionBy(*keys).orderBy(ch).rowsBetween(Window.unboundedPreceding, -1)
    cs = cs.withColumn("__pivot", F.sum(F.col("__n_c") * F.col("__mean_c")).over(wall)
                       / F.nullif(F.sum("__n_c").over(wall), F.lit(0)))
    dlt = F.coalesce(F.col("__mean_c") - F.col("__pivot"), F.lit(0.0))
    cs = cs.withColumns({
        "__d": dlt,
    }).withColumns({
        "__n_p": F.coalesce(F.sum("__n_c").over(wprev), F.lit(0)),
        "__s_p": F.coalesce(F.sum(F.col("__n_c") * F.col("__d")).over(wprev), F.lit(0.0)),
        "__q_p": F.coalesce(F.sum(F.col("__m2_c") + F.col("__n_c") * F.col("__d") * F.col("__d"))
                            .over(wprev), F.lit(0.0)),
        "__r_p": F.coalesce(F.sum("__rows_c").over(wprev), F.lit(0)),
    }).select(*keys, ch, "__pivot", "__n_p", "__s_p", "__q_p", "__r_p")
    # one row per (hot key, chunk); Spark broadcasts it by its size or joins where the windows put the rows
    j = local.join(cs, on=[*keys, ch], how="left")
    n_p = F.coalesce(F.col("__n_p"), F.lit(0)).cast("double")
    n_l = F.col("__n_l").cast("double")
    mean_p = F.col("__pivot") + F.col("__s_p") / F.nullif(n_p, F.lit(0.0))
    m2_p = F.col("__q_p") - F.col("__s_p") * F.col("__s_p") / F.nullif(n_p, F.lit(0.0))
    m2_l = F.coalesce(F.col("__var_l") * (n_l - F.lit(1.0)), F.lit(0.0))
    n = n_p + n_l
    mean = (F.when(n_p == 0, F.col("__mean_l"))
            .when(n_l == 0, mean_p)
            .otherwise((n_p * mean_p + n_l * F.col("__mean_l")) / n))
    delta = F.col("__mean_l") - mean_p
    m2 = (F.when(n_p == 0, m2_l).when(n_l == 0, m2_p)
          .otherwise(m2_p + m2_l + delta * delta * n_p * n_l / n))
    valid = ~_any_null(keys)
    exprs = {}
    if "mean" in names:
        exprs[names["mean"]] = F.when(valid & (n > 0), mean)
    if "std" in names:
        exprs[names["std"]] = F.when(valid & (n_p == 0), F.sqrt("__var_l")).when(
            valid & (n >= 2), F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - F.lit(1.0))))
    if "count" in names:
        exprs[names["count"]] = F.when(valid, F.coalesce(F.col("__n_p"), F.lit(0)) + F.col("__n_l")).cast("long")
    if "cumcount" in names:
        exprs[names["cumcount"]] = F.when(valid, F.coalesce(F.col("__r_p"), F.lit(0)) + F.col("__rn_l")).cast("int")
    return j.withColumns(exprs).select(*cols, *names.values())


def prior_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | None,
                mean: str | None = None, std: str | None = None, count: str | None = None,
                cumcount: str | None = None, skew_rows: int | None = DEFAULT_SKEW_ROWS,
                salt_col: str | None = None, hot: DataFrame | None = None,
                ranged: DataFrame | None = None) -> DataFrame:
    """Per row, statistics of ``value`` over the earlier rows of the same key.

    ``mean``/``std``/``count`` name the prior expanding mean, sample std (NULL for < 2 values, R11)
    and non-null count (W1-W6); ``cumcount`` names the zero-based occurrence number (W7, W8).
    ``order`` must end in a unique column (R4). ``skew_rows=None`` disables the hot-key path; ``hot``
    gives keys (with ``__rows``) already found to be above ``skew_rows``, ``ranged`` the rows that ``df`` was
    made from in range chunks of ``order``, whose chunk ids ``df`` still has.
    """
    names = {k: v for k, v in (("mean", mean), ("std", std), ("count", count),
                               ("cumcount", cumcount)) if v}
    keys, order = list(keys), list(order)
    if not skew_rows:
        return _direct(df, keys, order, value, names, salt_col)
    if hot is None:
        hot, n_hot, _ = find_hot_keys(df, keys, skew_rows)
        if n_hot == 0:
            return _direct(df, keys, order, value, names, salt_col)
    if ranged is not None:
        return _chunked(df, ranged, keys, order, value, names, hot)
    ranged = _range_chunks(df, [], order, _chunk_count(df.count(), skew_rows))
    return _chunked(ranged, ranged, keys, order, value, names, hot).drop(CHUNK)


def occurrence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                      skew_rows: int | None = DEFAULT_SKEW_ROWS) -> DataFrame:
    """Zero-based occurrence number within the key (pandas ``cumcount``)."""
    return prior_stats(df, keys, order, None, cumcount=out, skew_rows=skew_rows)


def _range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], n_chunks: int
                  ) -> DataFrame:
    """Contiguous, balanced chunks of the ``(keys, order)`` sequence: the range-partition id,
    materialised so every later step sees the same chunk boundaries."""
    return materialize(df.repartitionByRange(n_chunks, *[F.col(k) for k in keys],
                                             *_order_cols(order))
                       .withColumn(CHUNK, F.spark_partition_id()))


def _split_hot(df: DataFrame, keys: Sequence[str], skew_rows: int | None):
    """(cold rows, hot rows, number of chunks for the hot rows) — hot part None when no key holds
    more than ``skew_rows`` rows."""
    if not skew_rows:
        return df, None, 0
    hot, n_hot, hot_rows = find_hot_keys(df, keys, skew_rows)
    if n_hot == 0:
        return df, None, 0
    hk = hot.select(*keys)
    return (df.join(hk, on=list(keys), how="left_anti"),
            df.join(hk, on=list(keys), how="left_semi"),
            _chunk_count(hot_rows, skew_rows))


def overlap_flags(df: DataFrame, key: str, start: str, end: str, uid: str,
                  out: str = "overlaps_prev", skew_rows: int | None = DEFAULT_SKEW_ROWS
                  ) -> DataFrame:
    """Flag a registration that starts before the previous one (by start, id) of the same
    key ends. Rows with a NULL key, start or end, or that end at or before their start, are put
    aside before neighbours are compared: they hide no overlap, and their own flag is NULL.

    Hot keys: within a range chunk the previous row is a ``lag``; the first row of a chunk takes
    the last end of the key's previous chunk from the (small) chunk table."""
    valid = F.coalesce(F.col(key).isNotNull() & (F.col(end) > F.col(start)), F.lit(False))
    aside = df.where(~valid).withColumn(out, F.lit(None).cast("boolean"))
    cold, hot, n_chunks = _split_hot(df.where(valid), [key], skew_rows)
    w = Window.partitionBy(key).orderBy(F.col(start), F.col(uid))
    res = cold.withColumn("__prev", F.lag(end).over(w))
    if hot is not None:
        r = _range_chunks(hot, [key], [start, uid], n_chunks)
        wl = Window.partitionBy(key, "__chunk").orderBy(F.col(start), F.col(uid))
        loc = r.withColumns({"__lag": F.lag(end).over(wl), "__rn": F.row_number().over(wl)})
        last = r.groupBy(key, "__chunk").agg(
            F.max_by(F.col(end), F.struct(F.col(start), F.col(uid))).alias("__last"))
        wc = Window.partitionBy(key).orderBy("__chunk")
        last = last.withColumn("__prev_last", F.lag("__last").over(wc)).drop("__last")
        h = loc.join(last, [key, "__chunk"], "left").withColumn(
            "__prev", F.when(F.col("__rn") == 1, F.col("__prev_last")).otherwise(F.col("__lag")))
        h = h.drop("__lag", "__rn", "__prev_last", "__chunk")
        res = res.unionByName(h.select(*res.columns))
    flagged = res.withColumn(out, F.coalesce(F.col(start) < F.col("__prev"), F.lit(False)))
    return flagged.drop("__prev").unionByName(aside)


def remove_overlaps(df: DataFrame, key: str, start: str, end: str, uid: str,
                    skew_rows: int | None = DEFAULT_SKEW_ROWS) -> DataFrame:
    """Keep one registration per overlapping island of a key — the longest (ties: lowest id).

    Islands: running max of earlier ends; a row opens a new island when its start is at or after
    that max (touching intervals do not overlap). Rows with end <= start or NULL bounds are
    excluded as invalid. The pick per island is a ``max_by`` aggregate (partial, skew-safe).
    Hot keys: prefix max and island numbering continue across range chunks through the chunk
    table."""
    v = df.where(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()
                 & (F.col(end) > F.col(start)))
    cold, hot, n_chunks = _split_hot(v, [key], skew_rows)
    w = Window.partitionBy(key).orderBy(F.col(start), F.col(uid))
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)

    def new_flag(maxend):
        return F.when(maxend.isNull() | (F.col(start) >= maxend), 1).otherwise(0)

    c = cold.withColumn("__new", new_flag(F.max(end).over(prior)))
    c = c.withColumn("__island", F.sum("__new").over(upto)).drop("__new")
    parts = [c]
    if hot is not None:
        r = _range_chunks(hot, [key], [start, uid], n_chunks)
        wl = Window.partitionBy(key, "__chunk").orderBy(F.col(start), F.col(uid))
        wc = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        cmax = r.groupBy(key, "__chunk").agg(F.max(end).alias("__cmax"))\
            .withColumn("__pmax", F.max("__cmax").over(wc)).drop("__cmax")
        h = r.join(cmax, [key, "__chunk"], "left")
        local = F.max(end).over(wl.rowsBetween(Window.unboundedPreceding, -1))
        h = h.withColumn("__new", new_flag(F.greatest(local, F.col("__pmax")))).drop("__pmax")
        cnew = h.groupBy(key, "__chunk").agg(F.sum("__new").alias("__cn"))\
            .withColumn("__pn", F.coalesce(F.sum("__cn").over(wc), F.lit(0))).drop("__cn")
        h = h.join(cnew, [key, "__chunk"], "left").withColumn(
            "__island", F.col("__pn") + F.sum("__new").over(
                wl.rowsBetween(Window.unboundedPreceding, 0)))
        parts.append(h.drop("__new", "__pn", "__chunk").select(*c.columns))
    allr = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # time-zone free (no DST shifts whatever the session zone is)
    dur = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
    cols = [x for x in allr.columns if x not in (key, "__island")]
    best = allr.groupBy(key, "__island").agg(
        F.max_by(F.struct(*[F.col(x) for x in cols]), F.struct(dur, -F.col(uid))).alias("__r"))
    return best.select(key, *[F.col(f"__r.{x}").alias(x) for x in cols], "__island")


def history_features(df: DataFrame, tenant: str | None, employee: str, client: str, task: str,
                     date: str, uid: str, hours: str, skew_rows: int | None = DEFAULT_SKEW_ROWS,
                     task_speed_keys: Sequence[str] | None = None) -> DataFrame:
    """The employee history feature block of the reference, leak-free. With ``tenant`` None
    the ids of employees and tasks are taken to be unique across tenants.

    Output columns (reference names): med_gem_tijd, med_std_tijd, med_aantal_opdrachten (W1-W3 per
    tenant+employee), taak_gem (W4 per tenant+task), med_ervaring_bewerking (W7 per
    tenant+employee+task), med_klant_bezoeken / med_totaal_opdrachten (W8), med_klant_ratio (B5),
    med_klant_gem_tijd (W5), med_bewerking_gem_tijd (W6), med_klant_snelheid and
    med_bewerking_snelheid (B6 safe ratios to med_gem_tijd), med_snelheid_ratio (notebook:
    employee mean / task mean).
    """
    from hourloom.functions.columns import prior_ratio, safe_ratio

    order = [date, uid]
    of = [tenant] if tenant else []
    emp = [*of, employee]
    sets = [emp, [*of, task], [*emp, task], [*emp, client]]
    if task_speed_keys:
        sets.append(list(task_speed_keys))
    hot = hot_key_sets(df, sets, skew_rows) if skew_rows else {}

    def sk(keys):  # hot-key path only for key sets that have a hot key
        found = hot.get(tuple(keys))
        return {"skew_rows": skew_rows if found is not None else None, "hot": found, "ranged": ranged}

    ranged = None
    if hot:                # all key sets share the order, so also its chunks: cut and written once
        df = ranged = _range_chunks(df, [], order, _chunk_count(df.count(), skew_rows))

    # W4 (tenant, task) first; then the three employee key sets share one salt column, so one
    # hash partitioning on (tenant, employee, salt) serves all of them (a subset of each key set)
    out = prior_stats(df, [*of, task], order, hours, mean="taak_gem",
                      **sk([*of, task]))
    salt = "__emp_salt"
    out = out.withColumn(salt, _null_salt(emp, order))
    out = prior_stats(out, emp, order, hours, mean="med_gem_tijd", std="med_std_tijd",
                      count="med_aantal_opdrachten", cumcount="med_totaal_opdrachten",
                      **sk(emp), salt_col=salt)
    out = prior_stats(out, [*emp, task], order, hours, mean="med_bewerking_gem_tijd",
                      cumcount="med_ervaring_bewerking", **sk([*emp, task]),
                      salt_col=salt)
    if task_speed_keys:
        out = prior_stats(out, list(task_speed_keys), order, hours, mean="__speed_mean",
                          **sk(task_speed_keys))
        out = out.withColumn("med_bewerking_gem_tijd", F.col("__speed_mean")).drop("__speed_mean")
    out = prior_stats(out, [*emp, client], order, hours, mean="med_klant_gem_tijd",
                      cumcount="med_klant_bezoeken", **sk([*emp, client]), salt_col=salt)
    out = out.drop(salt, CHUNK)
    return out.withColumns({
        "med_klant_ratio": prior_ratio("med_klant_bezoeken", "med_totaal_opdrachten"),
        "med_klant_snelheid": safe_ratio("med_klant_gem_tijd", "med_gem_tijd"),
        "med_bewerking_snelheid": safe_ratio("med_bewerking_gem_tijd", "med_gem_tijd"),
        "med_snelheid_ratio": F.col("med_gem_tijd") / F.nullif(F.col("taak_gem"), F.lit(0.0)),
    })
