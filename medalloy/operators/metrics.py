"""Derived Gold metrics (M1–M13, P9): null-safe ratios, bands and spreads as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num, den, *, scale: float = 1.0, digits: int | None = 2) -> Column:
    """P9 — ``num/den·scale`` when den is present and non-zero, else NULL."""
    n, d = _c(num), _c(den)
    r = F.when(d.isNotNull() & (d != 0), n / d * F.lit(scale))
    return F.round(r, digits) if digits is not None else r


def price_to_rent(value, rent) -> Column:
    """M1 — value / (monthly rent × 12)."""
    return safe_ratio(_c(value), _c(rent) * 12)


def gross_yield_pct(value, rent) -> Column:
    """M2 — rent × 12 / value × 100."""
    return safe_ratio(_c(rent) * 12, _c(value), scale=100.0)


def real_value(nominal, index, base_index, digits: int | None = 2) -> Column:
    """M5 — nominal × base / index."""
    return safe_ratio(_c(nominal) * _c(base_index), _c(index), digits=digits)


def affordability(value, national_rate) -> Column:
    """M6 — metro value × the national rate on the same date (NULL where the rate is absent)."""
    return _c(value) * _c(national_rate)


def rebase(df: DataFrame, keys: Sequence[str], order: str, value: str, *, ref_filter: Column,
           out: str = "rebased", digits: int | None = 2) -> DataFrame:
    """M7 — ``100·x / x_ref`` per entity, x_ref = the entity's value in the reference period."""
    ref = df.where(ref_filter).groupBy(*keys).agg(F.max_by(value, order).alias("_ref"))
    return df.join(ref, list(keys), "left").withColumn(out, safe_ratio(F.col(value), F.col("_ref"), scale=100.0,
                                                                       digits=digits)).drop("_ref")


def confidence_band(x, se, z: float = 1.96, digits: int | None = 2) -> tuple[Column, Column]:
    """M8 — (x − z·se, x + z·se)."""
    lo, hi = _c(x) - F.lit(z) * _c(se), _c(x) + F.lit(z) * _c(se)
    if digits is not None:
        lo, hi = F.round(lo, digits), F.round(hi, digits)
    return lo, hi


# Fixed-width score bands (upper bound exclusive except the last) and labels.
RISK_BANDS = [(0, 20, "Very Low"), (20, 40, "Relatively Low"), (40, 60, "Relatively Moderate"),
              (60, 80, "Relatively High"), (80, 100, "Very High")]


def risk_band(score, *, higher_is_better: bool = False) -> tuple[Column, Column]:
    """M9/T12 — (label, sort key 1–5); NULL score → 'No Rating' with key 0. With
    ``higher_is_better`` the scale is flipped (resilience-type scores)."""
    s = _c(score)
    s = F.lit(100) - s if higher_is_better else s
    label = F.when(s.isNull(), F.lit("No Rating"))
    key = F.when(s.isNull(), F.lit(0))
    for i, (lo, hi, name) in enumerate(RISK_BANDS, 1):
        cond = (s >= lo) & ((s < hi) if hi < 100 else (s <= hi))
        label = label.when(cond, F.lit(name))
        key = key.when(cond, F.lit(i))
    return label, key


def natural_breaks(scores: DataFrame, score: str, bands: int, digits: int = 2) -> DataFrame:
    """M9 — the exact one-dimensional k-means of scores rounded to ``digits``: (band, low, high, n), band 1 lowest.

    Spark counts the rounded scores; a dynamic programme over these distinct values finds the cut
    of least squared distance (sums of squares about the means), the lowest cuts among equals. Distinct
    values are bounded by the score's range and ``digits`` (10,001 for 0-100 with two), rows are not
    collected. NULL and non-finite scores take no part; fewer distinct values than bands give fewer bands.
    """
    scale = 10 ** digits
    s = _c(score).cast("double")
    finite = F.when(~F.isnan(s) & (F.abs(s) != float("inf")), s)
    x = F.round(F.round(finite, digits) * scale).cast("long")
    hist = scores.select(x.alias("x")).where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n")).orderBy("x").collect()
    cuts = least_square_cuts([r.x for r in hist], [r.n for r in hist], bands)
    rows = [(i + 1, hist[a].x / scale, hist[b - 1].x / scale, sum(r.n for r in hist[a:b])) for i, (a, b) in enumerate(cuts)]
    return scores.sparkSession.createDataFrame(rows, "band int, low double, high double, n long")


def least_square_cuts(x: Sequence[int], n: Sequence[int], k: int) -> list[tuple[int, int]]:
    """(start, end) of the ``k`` stretches of sorted values ``x`` with counts ``n`` of least summed squared distance.

    Costs are compared as floats of exact integer sums. Splits rise with the end point, so each layer
    is found by halving: k n log n steps.
    """
    m = len(x)
    k = min(k, m)
    if not k:
        return []
    w, wx, wxx = [0], [0], [0]
    for v, c in zip(x, n, strict=True):
        w.append(w[-1] + c)
        wx.append(wx[-1] + c * v)
        wxx.append(wxx[-1] + c * v * v)

    def cost(a: int, b: int) -> float:
        s = wx[b] - wx[a]
        return ((wxx[b] - wxx[a]) * (w[b] - w[a]) - s * s) / (w[b] - w[a])

    best = [0.0] + [cost(0, b) for b in range(1, m + 1)]
    splits: list[list[int]] = []
    for layer in range(2, k + 1):
        now, at = [float("inf")] * (m + 1), [0] * (m + 1)
        todo = [(layer, m, layer - 1, m - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            b = (lo + hi) // 2
            for a in range(first, min(last, b - 1) + 1):
                c = best[a] + cost(a, b)
                if c < now[b]:
                    now[b], at[b] = c, a
            todo += [(lo, b - 1, first, at[b]), (b + 1, hi, at[b], last)]
        best = now
        splits.append(at)
    ends = [m]
    for at in reversed(splits):
        ends.append(at[ends[-1]])
    ends = [*ends, 0][::-1] if k > 1 else [0, m]
    return list(zip(ends[:-1], ends[1:], strict=True))


def spread(metro_growth, national_growth, digits: int | None = 2) -> Column:
    """M10 — metro minus national growth on the same date."""
    d = _c(metro_growth) - _c(national_growth)
    return F.round(d, digits) if digits is not None else d


def heat_band(pending_ratio, hot: float = 0.6, cold: float = 0.2) -> Column:
    """M11 — 'hot' above ``hot``, 'cold' below ``cold``, else 'neutral'; NULL stays NULL."""
    r = _c(pending_ratio)
    return F.when(r > hot, "hot").when(r < cold, "cold").when(r.isNotNull(), "neutral")


def bps_change(rate, prior_rate) -> Column:
    """M12 — (r − r_prior) × 100 basis points."""
    return F.round((_c(rate) - _c(prior_rate)) * 100, 2)


def rent_burden(rent, income) -> Column:
    """M13 — rent × 12 / income × 100."""
    return safe_ratio(_c(rent) * 12, _c(income), scale=100.0)


def first_in_window(value: str, keys: Sequence[str], order: str) -> Column:
    """Entity's first value in time (alternative rebase reference)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(value).over(w)
