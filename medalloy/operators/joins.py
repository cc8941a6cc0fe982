"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outer_merge_feeds(feeds: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """J6 — N-way FULL OUTER JOIN ... USING(keys) of feeds that are unique per key, as one
    union + group-by (a single shuffle on the keys instead of N-1 outer joins). Each
    feed's value columns are taken with ``max`` (exactly one row contributes)."""
    keys = list(keys)
    value_cols = [[c for c in f.columns if c not in keys] for f in feeds]
    all_vals = [c for cols in value_cols for c in cols]
    parts = []
    for f, cols in zip(feeds, value_cols):
        parts.append(f.select(*keys, *[F.col(c) if c in cols else F.lit(None).alias(c) for c in all_vals]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    types = {c: t for f in feeds for c, t in f.dtypes}
    return u.groupBy(*keys).agg(*[F.max(F.col(c)).cast(types[c]).alias(c) for c in all_vals])


def full_outer_coalesce(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J7 — full outer join with a coalesced key column."""
    lr = left.withColumnRenamed(key, "_lk")
    rr = right.withColumnRenamed(key, "_rk")
    j = lr.join(rr, F.col("_lk") == F.col("_rk"), "full_outer")
    rest = [c for c in j.columns if c not in ("_lk", "_rk")]
    return j.select(F.coalesce("_lk", "_rk").alias(key), *rest)


def rename(df: DataFrame, pairs: Sequence[tuple[str, str]], *, round_digits: int | None = None,
           no_round: Sequence[str] = ()) -> DataFrame:
    """P1/P2 — ordered (source, target) projection; optional rounding of fractional columns
    except the ``no_round`` set."""
    types = dict(df.dtypes)
    out = []
    for s, d in pairs:
        c = F.col(s)
        if round_digits is not None and d not in no_round and types.get(s) in ("double", "float"):
            c = F.round(c, round_digits)
        out.append(c.alias(d))
    return df.select(*out)
