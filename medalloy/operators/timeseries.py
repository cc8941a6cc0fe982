"""Time-series operators: latest-per-key, period spines, as-of fill, calendar-exact
changes, rolling windows, ranks and gap reports (N1–N10, J9–J11, A6, A8–A11, M3).

Scale notes
-----------
* "Latest row per key" is an aggregation (``max`` of an ordered struct), not a
  ``row_number`` window: it combines map-side, so a key holding a third of all
  rows never lands whole in one task.
* Ordered windows (as-of, lag, rolling, rank) run only on data already reduced
  to one row per (entity, period). A window partition then holds at most the
  number of periods on the calendar (or entities in a dimension), not a share
  of the raw rows.
* Calendar-exact "prior period" uses a RANGE frame on an integer period
  ordinal instead of a self-join: one shuffle, no fan-out on duplicate keys,
  NULL across gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalloy.functions.dates import month_ordinal, quarter_ordinal
from medalloy.store import cut_lineage


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


# --------------------------------------------------------------------------- latest / last


def latest_per_key(df: DataFrame, keys, order, *, columns: Sequence[str] | None = None,
                   descending: bool = True) -> DataFrame:
    """One row per ``keys``: the row with the greatest (or least) ``order`` tuple.

    ``order`` must make the choice total (add tie-break columns); the result is then
    deterministic regardless of partitioning. Implemented as ``max``/``min`` of a
    struct, which Spark aggregates partially before the shuffle.
    """
    keys, order = _cols(keys), _cols(order)
    payload = [c for c in (columns or df.columns) if c not in keys]
    ordered = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                       F.struct(*[F.col(c) for c in payload]).alias("_p"))
    pick = F.max(ordered) if descending else F.min(ordered)
    return df.groupBy(*keys).agg(pick.alias("_m")).select(*keys, *[F.col(f"_m._p.{c}").alias(c) for c in payload])


def period_end(d, period: str = "month") -> Column:
    d = F.col(d) if isinstance(d, str) else d
    if period == "month":
        return F.last_day(d)
    if period == "quarter":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    if period == "year":
        return F.last_day(F.add_months(F.trunc(d, "year"), 11))
    raise ValueError(f"unknown period {period!r}")


def last_in_period(df: DataFrame, keys, date_col: str, values, *, period: str = "month",
                   tiebreak=(), period_col: str = "period_end") -> DataFrame:
    """N2 — the last observation of each (keys, period): keys, period_end, date, values."""
    keys, values, tiebreak = _cols(keys), _cols(values), _cols(tiebreak)
    staged = df.select(*keys, period_end(date_col, period).alias(period_col), date_col, *tiebreak, *values)
    out = latest_per_key(staged, keys + [period_col], [date_col, *tiebreak], columns=[date_col, *values])
    return out


# --------------------------------------------------------------------------- spines / as-of


def month_spine(series: DataFrame, lo: Column, hi: Column, *, month_col: str = "month_end") -> DataFrame:
    """Every month-end in ``[lo, hi]`` for every row of ``series`` (a per-row generator, not a
    cross join). ``lo``/``hi`` may be columns of ``series`` or scalar subqueries."""
    months = F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.expr("INTERVAL 1 MONTH"))
    exploded = series.select(*series.columns, F.explode(months).alias("_m"))
    return exploded.select(*series.columns, F.last_day("_m").alias(month_col))


def asof_fill(spine: DataFrame, obs: DataFrame, keys, *, spine_date: str, obs_date: str, values,
              skip_nulls: bool = False, carry_date_as: str | None = None) -> DataFrame:
    """J11 — backward as-of join: each spine row takes the latest observation of the same
    keys with ``obs_date <= spine_date``.

    * spine rows before the first observation keep NULL values;
    * with ``skip_nulls=False`` (the reference rule) the latest observation wins even if
      its value is NULL — the value travels inside a struct so ``ignorenulls`` skips only
      rows that carry no observation;
    * ``skip_nulls=True`` carries each value's latest non-null instead.

    Implemented as union + ordered window (one shuffle on ``keys``) instead of a theta
    join + ``row_number``, whose output is quadratic per key. Observations must be
    unique per (keys, obs_date); reduce them with :func:`last_in_period` first so a
    window partition holds at most one row per period.
    """
    keys, values = _cols(keys), _cols(values)
    extra = [c for c in spine.columns if c not in keys and c != spine_date]
    s = spine.select(*keys, F.col(spine_date).alias("_d"), F.lit(1).alias("_t"), *extra,
                     F.lit(None).alias("_dummy"))
    carried = [F.col(obs_date).alias("_od"), *[F.col(v) for v in values]]
    if skip_nulls:
        o = obs.select(*keys, F.col(obs_date).alias("_d"), F.lit(0).alias("_t"),
                       *[F.col(v).alias(f"_v_{v}") for v in values], F.col(obs_date).alias("_od"))
    else:
        o = obs.select(*keys, F.col(obs_date).alias("_d"), F.lit(0).alias("_t"),
                       F.struct(*carried).alias("_v"))
    u = s.drop("_dummy").unionByName(o, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_d", "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if skip_nulls:
        filled = u.select(
            *keys, "_d", "_t", *extra,
            *[F.last(f"_v_{v}", ignorenulls=True).over(w).alias(v) for v in values],
            F.last("_od", ignorenulls=True).over(w).alias("_od"),
        )
        out_vals = [F.col(v) for v in values]
        od = F.col("_od")
    else:
        filled = u.select(*keys, "_d", "_t", *extra, F.last("_v", ignorenulls=True).over(w).alias("_f"))
        out_vals = [F.col(f"_f.{v}").alias(v) for v in values]
        od = F.col("_f._od")
    cols = [*keys, F.col("_d").alias(spine_date), *extra, *out_vals]
    if carry_date_as:
        cols.append(od.alias(carry_date_as))
    return filled.where(F.col("_t") == 1).select(*cols)


def pivot_wide(long: DataFrame, index, series_col: str, value_col: str, mapping: dict[str, str]) -> DataFrame:
    """R6/A7 — long → wide with a fixed value list (no extra distinct job); one column per
    mapped series, ``first`` value (inputs are unique per index × series)."""
    index = _cols(index)
    wide = long.groupBy(*index).pivot(series_col, list(mapping)).agg(F.first(value_col))
    return wide.select(*index, *[F.col(f"`{k}`").alias(v) for k, v in mapping.items()])


# --------------------------------------------------------------------------- changes / windows


def _ordinal(d: str, grain: str) -> Column:
    return month_ordinal(d) if grain == "month" else quarter_ordinal(d)


def prior_value(keys, ordinal: str, value: str, lag: int) -> Column:
    """Value of the same entity exactly ``lag`` periods earlier (NULL across a gap)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(F.col(ordinal)).rangeBetween(-lag, -lag)
    return F.first(F.col(value)).over(w)


def pct_change(cur: Column, prior: Column, *, scale: float = 100.0, digits: int | None = 2) -> Column:
    """M3 — ``(cur-prior)/prior*scale``; NULL when prior is NULL or 0."""
    ch = F.when(prior.isNotNull() & (prior != 0), (cur - prior) / prior * F.lit(scale))
    return F.round(ch, digits) if digits is not None else ch


def period_change(df: DataFrame, keys, date_col: str, value: str, *, grain: str = "quarter",
                  lag: int = 4, out: str = "pct_change_yoy", scale: float = 100.0,
                  digits: int | None = 2) -> DataFrame:
    """J9/M3/N9 — calendar-exact change vs ``lag`` periods earlier (4 quarters or 12 months = YoY)."""
    keys = _cols(keys)
    staged = df.withColumn("_ord", _ordinal(date_col, grain))
    prior = prior_value(keys, "_ord", value, lag)
    return staged.withColumn(out, pct_change(F.col(value), prior, scale=scale, digits=digits)).drop("_ord")


def rolling_mean(df: DataFrame, keys, date_col: str, value: str, months: int, *, out: str | None = None,
                 digits: int | None = 2) -> DataFrame:
    """N8 — trailing ``months``-month mean on the month ordinal (a gap shrinks the frame,
    it never reaches further back)."""
    keys = _cols(keys)
    w = Window.partitionBy(*keys).orderBy(F.col("_ord")).rangeBetween(-(months - 1), 0)
    m = F.avg(F.col(value)).over(w)
    return (df.withColumn("_ord", month_ordinal(date_col))
              .withColumn(out or f"{value}_avg_{months}m", F.round(m, digits) if digits is not None else m)
              .drop("_ord"))


def year_to_date(df: DataFrame, keys, date_col: str, value: str, *, out: str | None = None,
                 digits: int | None = 2) -> DataFrame:
    """N8 — running sum from January of the same year."""
    keys = _cols(keys)
    w = (Window.partitionBy(*keys, F.year(date_col)).orderBy(F.month(date_col))
         .rangeBetween(Window.unboundedPreceding, 0))
    s = F.sum(F.col(value)).over(w)
    return df.withColumn(out or f"{value}_ytd", F.round(s, digits) if digits is not None else s)


def rank_in_period(df: DataFrame, period_cols, value: str, *, prefix: str = "", buckets: int = 64) -> DataFrame:
    """N10 — rank / dense rank / percent rank of entities within a period (descending value,
    NULLs last), equal to the window functions but with no period held whole by one task.

    The cuts (at most ``buckets`` numbers per period) are found once and kept by a reliable
    checkpoint: offsets and ranks read the same ones, also where an approximate quantile would
    come out otherwise when computed again.

    Ties collapse first: distinct (period, value) with their row count (map-side combine, so
    a value shared by a third of all rows is one row). Each period's distinct values are cut
    into ``buckets`` value ranges at approximate quantiles (the cuts only balance the work;
    ranks stay exact because equal values always share a bucket). Rows and distinct values
    before a value = totals of the earlier buckets (a window over ≤ ``buckets`` + 1 rows per
    period) + those before it inside its bucket (a window over one bucket). The ranks join
    back to the rows on (period, value), null-safe.
    """
    p = _cols(period_cols)
    v = F.col(value)
    vc = df.groupBy(*p, value).agg(F.count(F.lit(1)).alias("_c"))
    buckets = max(1, int(buckets))
    fracs = [i / buckets for i in range(1, buckets)]
    cuts = vc.groupBy(*p).agg(
        *([F.percentile_approx(value, fracs, 10000).alias("_cuts")] if fracs else []),
        F.sum("_c").alias("_n"))
    cuts = cut_lineage(cuts)
    # bucket = number of cut points above the value (descending order); NULL sorts last
    above = F.size(F.filter("_cuts", lambda c: c > v)) if fracs else F.lit(0)
    b = (vc.join(cuts, p)
           .withColumn("_b", F.when(v.isNull(), F.lit(buckets)).otherwise(above))
           .drop(*(["_cuts"] if fracs else [])))
    before = Window.partitionBy(*p).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (b.groupBy(*p, "_b").agg(F.sum("_c").alias("_bc"), F.count(F.lit(1)).alias("_bd"))
                .select(*p, "_b", F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_rows_off"),
                        F.coalesce(F.sum("_bd").over(before), F.lit(0)).alias("_dist_off")))
    inside = Window.partitionBy(*p, "_b").orderBy(v.desc_nulls_last())
    ranked = (b.select(*p, value, "_b", "_n",
                       F.coalesce(F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                        .alias("_rows_before"),
                       (F.row_number().over(inside) - 1).alias("_dist_before"))
               .join(offsets, [*p, "_b"]))
    rank = F.col("_rows_off") + F.col("_rows_before") + 1
    ranks = ranked.select(
        *[F.col(c).alias(f"_k_{c}") for c in p], F.col(value).alias("_k_v"),
        rank.cast("int").alias(f"{prefix}rank"),
        (F.col("_dist_off") + F.col("_dist_before") + 1).cast("int").alias(f"{prefix}dense_rank"),
        F.round(F.when(F.col("_n") > 1, (rank - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0)), 6)
         .alias(f"{prefix}pct_rank"))
    cond = [df[c] == F.col(f"_k_{c}") for c in p] + [df[value].eqNullSafe(F.col("_k_v"))]
    return (df.join(ranks, cond, "left")
              .select(*[df[c] for c in df.columns], f"{prefix}rank", f"{prefix}dense_rank", f"{prefix}pct_rank"))


# --------------------------------------------------------------------------- gaps


def ordinal_gaps(df: DataFrame, keys, ordinal: Column | str) -> DataFrame:
    """A8 — per entity: present rows, span ``max-min+1`` and missing periods."""
    o = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return (df.groupBy(*_cols(keys))
              .agg(F.count(F.lit(1)).alias("present"), (F.max(o) - F.min(o) + 1).alias("span"))
              .withColumn("missing", F.col("span") - F.col("present")))


def gap_summary(gaps: DataFrame, *, label: str, grain: str) -> DataFrame:
    """A9 — one row per fact: entities, rows, entities_with_gaps, missing_periods, verdict."""
    g = gaps.agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum("present").cast("long").alias("rows"),
        F.sum(F.when(F.col("missing") > 0, 1).otherwise(0)).cast("long").alias("entities_with_gaps"),
        F.sum("missing").cast("long").alias("missing_periods"),
    )
    return g.select(F.lit(label).alias("fact"), F.lit(grain).alias("grain"), "*",
                    F.when(F.col("missing_periods") == 0, "OK").otherwise("GAPS").alias("verdict"))


def day_spacing(df: DataFrame, keys, date_col: str) -> DataFrame:
    """N4 — days since the previous distinct observation date of the same series."""
    keys = _cols(keys)
    d = df.select(*keys, F.to_date(date_col).alias("obs_date")).distinct()
    w = Window.partitionBy(*keys).orderBy("obs_date")
    return d.withColumn("gap_days", F.datediff("obs_date", F.lag("obs_date").over(w)))


def native_gaps(df: DataFrame, keys, date_col: str, *, tolerance: float = 1.5) -> DataFrame:
    """A10/A11/N5 — per series: observations, modal day spacing (ties → smaller gap) and the
    estimated missing count ``Σ(round(gap/modal)-1)`` over gaps above ``tolerance × modal``."""
    keys = _cols(keys)
    sp = day_spacing(df, keys, date_col)
    n = sp.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    freq = sp.where(F.col("gap_days").isNotNull()).groupBy(*keys, "gap_days").agg(F.count(F.lit(1)).alias("cnt"))
    modal = (freq.groupBy(*keys)
                 .agg(F.max(F.struct(F.col("cnt"), (-F.col("gap_days")).alias("neg"))).alias("m"))
                 .select(*keys, (-F.col("m.neg")).alias("modal_days")))
    miss = (sp.join(modal, keys)
              .where(F.col("gap_days") > F.col("modal_days") * F.lit(tolerance))
              .groupBy(*keys)
              .agg(F.sum(F.round(F.col("gap_days") / F.col("modal_days")).cast("int") - 1).cast("long").alias("missing")))
    return (n.join(modal, keys, "left").join(miss, keys, "left")
             .select(*keys, "n", "modal_days", F.coalesce("missing", F.lit(0)).cast("long").alias("missing")))
