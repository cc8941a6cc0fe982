"""Geographic rollups.

All rollups are ``groupBy().agg()`` with partial (map-side) aggregation, so a hot
group is combined per input partition before the shuffle. Weighted means use a
per-measure denominator (only rows whose measure is present contribute weight)
and ``try_divide`` so an all-zero weight total gives NULL instead of an ANSI error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.operators.sizing import broadcast_if_small


def weighted_mean(x: Column, w: Column) -> Column:
    """A3 — Σ(x·w) / Σ(w where x is present); NULL for an all-null group or zero weight."""
    return F.try_divide(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def ratio_of_sums(num: Column, den: Column) -> Column:
    """A14 — Σnum / Σden at a coarser grain (never an average of ratios)."""
    return F.try_divide(F.sum(num), F.sum(den))


def bridge_rollup(df: DataFrame, bridge: DataFrame | None, *, by: str | Sequence[str], on: str | None = None,
                  sums: Mapping[str, str] | None = None, round_sums: Mapping[str, str] | None = None,
                  weighted: Mapping[str, str] | None = None, weight: str | None = None,
                  means: Mapping[str, str] | None = None, counts: Mapping[str, str | None] | None = None,
                  mins: Mapping[str, str] | None = None, digits: int | None = None) -> DataFrame:
    """J1/A2–A5 — optional inner join to a bridge (uncovered rows drop by design), then
    extensive sums, rounded sums (→ BIGINT), weighted intensive means, plain null-skipping
    means, counts and string-min representatives per ``by``.

    Output columns are named by the mapping keys: ``{"population": "pop_col"}``.
    """
    by = [by] if isinstance(by, str) else list(by)
    if bridge is not None:
        df = df.join(broadcast_if_small(bridge), on or by, "inner")

    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    aggs: list[Column] = []
    for out, src in (sums or {}).items():
        aggs.append(r(F.sum(F.col(src))).alias(out))
    for out, src in (round_sums or {}).items():
        aggs.append(F.round(F.sum(F.col(src))).cast("long").alias(out))
    for out, src in (weighted or {}).items():
        aggs.append(r(weighted_mean(F.col(src), F.col(weight))).alias(out))
    for out, src in (means or {}).items():
        aggs.append(r(F.avg(F.col(src))).alias(out))
    for out, src in (counts or {}).items():
        aggs.append(F.count(F.lit(1) if src is None else F.col(src)).alias(out))
    for out, src in (mins or {}).items():
        aggs.append(F.min(F.col(src)).alias(out))
    return df.groupBy(*by).agg(*aggs)


def level_stack(df: DataFrame, levels: Sequence[tuple[str, str, str | None]], *, sums: Mapping[str, str],
                count_col: str = "n_members", count_of: str | None = None,
                weighted: Mapping[str, str] | None = None, weight: str | None = None,
                digits: int | None = 2) -> DataFrame:
    """R7 — one table of ``(geo_level, geo_id, geo_name, members, …)`` for several levels of a
    hierarchy, computed by a single ``GROUPING SETS`` aggregate (one scan, one shuffle).

    ``levels`` = [(level_name, id_col, name_col_or_None), ...].
    """
    group_cols: list[str] = []
    for _, i, nm in levels:
        for c in (i, nm):
            if c and c not in group_cols:
                group_cols.append(c)

    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    aggs = [F.count(F.lit(1) if count_of is None else F.col(count_of)).alias(count_col)]
    aggs += [r(F.sum(F.col(src))).alias(out) for out, src in sums.items()]
    aggs += [r(weighted_mean(F.col(src), F.col(weight))).alias(out) for out, src in (weighted or {}).items()]
    sets = [[F.col(i)] + ([F.col(nm)] if nm else []) for _, i, nm in levels]
    out = df.groupingSets(sets, *[F.col(c) for c in group_cols]).agg(*aggs, F.grouping_id().alias("_gid"))
    # grouping_id: bit (n-1-k) is set when group_cols[k] is aggregated away.
    n = len(group_cols)
    level_col = id_col = name_col = F.lit(None).cast("string")
    for lvl, i, nm in levels:
        kept = {group_cols.index(i)} | ({group_cols.index(nm)} if nm else set())
        gid = sum(1 << (n - 1 - k) for k in range(n) if k not in kept)
        hit = F.col("_gid") == gid
        level_col = F.when(hit, F.lit(lvl)).otherwise(level_col)
        id_col = F.when(hit, F.col(i).cast("string")).otherwise(id_col)
        name_col = F.when(hit, F.col(nm).cast("string") if nm else F.lit(None).cast("string")).otherwise(name_col)
    return out.select(level_col.alias("geo_level"), id_col.alias("geo_id"), name_col.alias("geo_name"),
                      count_col, *sums, *(weighted or {}))
