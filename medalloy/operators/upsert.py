"""Keyed upserts without a MERGE-capable table format.

``merge_upsert`` is one full-outer join on the keys: both sides are hash-partitioned on
the keys exactly once and the result carries a ``_change`` column
(insert / update / unchanged / kept) so metrics come from the same pass as the write
(``DataFrame.observe`` in :mod:`medalloy.store`). The source is first reduced to one
row per key by an aggregation (``max`` of an ordered struct): the duplicate count is
kept in ``_src_rows`` so a writer can refuse a batch with duplicate keys (W6) before
committing, and a priority column resolves ordered multi-file loads (W4).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalloy.session import ensure_checkpoint_dir

INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Reduce ``source`` to one row per key: greatest ``order`` tuple wins; remaining ties are
    broken by the full row so the pick is deterministic. Adds ``_src_rows``."""
    keys = _list(keys)
    payload = [c for c in source.columns if c not in keys]
    ordered = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                       F.struct(*[F.col(c) for c in payload]).alias("_p"))
    g = source.groupBy(*keys).agg(F.max(ordered).alias("_m"), F.count(F.lit(1)).alias("_src_rows"))
    return g.select(*keys, *[F.col(f"_m._p.{c}").alias(c) for c in payload], "_src_rows")


def merge_upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str], *,
                 update: str | Sequence[str] = "all", keep: Sequence[str] = (),
                 hash_col: str = "row_hash", order: Sequence[str] = (),
                 change_col: str = "_change", touch: dict[str, Column] | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` by ``keys``; never deletes target-only keys.

    update="all"   W1: a matched row takes every source column (by name).
    update="hash"  W2: a matched row is replaced only if ``NOT (t.hash <=> s.hash)`` (T4:
                   a NULL hash on either side counts as changed).
    update=[cols]  W3: only the listed columns come from the source; the rest (e.g.
                   ``inserted_ts``) stay; ``touch`` sets columns on updated rows
                   (e.g. ``{"updated_ts": F.current_timestamp()}``).
    A NULL key equals no key, as in MERGE: such a source row is inserted.
    ``keep`` columns always keep the target value on a match.
    Output: target's columns (in order), ``change_col`` and ``_src_rows``.
    """
    keys = _list(keys)
    cols = [c for c in target.columns if c not in keys]
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    s = one_per_key(source.select(*keys, *cols, *[o for o in order if o not in target.columns]), keys, order)
    t = target.select(*keys, *cols, F.lit(True).alias("_in_t"))
    s = s.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols], "_src_rows", F.lit(True).alias("_in_s"))
    j = t.join(s, keys, "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()

    if update == "hash":
        changed = ~F.col(hash_col).eqNullSafe(F.col(f"_s_{hash_col}"))
        from_source = set(cols)
    elif update == "all":
        changed = F.lit(True)
        from_source = set(cols)
    else:
        changed = F.lit(True)
        from_source = set(_list(update))
    from_source -= set(keep)
    change = (F.when(in_t & in_s, F.when(changed, F.lit(UPDATE)).otherwise(F.lit(UNCHANGED)))
               .when(in_s, F.lit(INSERT)).otherwise(F.lit(KEPT)))
    j = j.withColumn(change_col, change)
    is_ins, is_upd = F.col(change_col) == INSERT, F.col(change_col) == UPDATE
    out = []
    for c in cols:
        if touch and c in touch:
            v = F.when(is_ins | is_upd, touch[c]).otherwise(F.col(c))
        elif c in from_source:
            v = F.when(is_ins | is_upd, F.col(f"_s_{c}")).otherwise(F.col(c))
        else:
            v = F.when(is_ins, F.col(f"_s_{c}")).otherwise(F.col(c))
        out.append(v.alias(c))
    return j.select(*keys, *out, change_col, F.coalesce("_src_rows", F.lit(0)).alias("_src_rows"))


def change_counts(merged: DataFrame, change_col: str = "_change") -> DataFrame:
    """W5 — rows per change kind."""
    return merged.groupBy(change_col).agg(F.count(F.lit(1)).alias("n_rows"))


def prioritise(frames: Sequence[DataFrame], priority_col: str = "_priority") -> DataFrame:
    """W4 — union of ordered inputs tagged with their position (later input = higher priority)."""
    tagged = [f.withColumn(priority_col, F.lit(i)) for i, f in enumerate(frames)]
    out = tagged[0]
    for f in tagged[1:]:
        out = out.unionByName(f)
    return out


def dense_positions(df: DataFrame, order: Sequence[str], out: str = "_pos") -> DataFrame:
    """1-based position of each row in the total order of ``order`` (distinct values), fully
    distributed and JVM-side: range-partition and sort by ``order``, take each row's index
    inside its partition from ``monotonically_increasing_id`` (partition id in the high
    bits, row index in the low 33), and add the row counts of all earlier partitions (a
    table with one row per partition). The position is the row's global sorted rank, so it
    does not depend on where the range boundaries fall.

    The partitioned frame is materialised once with a reliable ``checkpoint()`` (shared
    checkpoint dir) so the offsets and the rows see the same partitioning — two evaluations
    could otherwise sample different range boundaries. This runs one job (a load step).
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = max(1, df.sparkSession.sparkContext.defaultParallelism)
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33))
           .checkpoint(eager=True))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid")  # one row per partition
             .withColumn(out, F.col("_off") + F.col("_local") + 1)
             .drop("_pid", "_local", "_off"))


def assign_surrogates(target: DataFrame, source: DataFrame, natural_keys: str | Sequence[str],
                      key_col: str) -> DataFrame:
    """W7 — keep existing surrogate keys; give new natural keys ``max(key) + rank`` in
    natural-key order. Keys compare null-safe: a NULL natural key is one key with one id. Ranks come from :func:`dense_positions` (distributed sort, per-partition
    offsets), never a single-partition window, and are deterministic for a given input
    (unlike ``monotonically_increasing_id`` alone)."""
    natural_keys = _list(natural_keys)
    nk = source.select(*natural_keys).distinct()
    existing = target.select(*natural_keys, key_col)
    old = existing.select(*[F.col(k).alias(f"_old_{k}") for k in natural_keys])
    same = [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in natural_keys]
    new = nk.join(old, reduce(and_, same), "left_anti")
    base = target.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long").alias("b"))
    ranked = dense_positions(new, natural_keys, "_rank")
    fresh = ranked.select(*natural_keys, (F.col("_rank") + base.scalar()).cast("long").alias(key_col))
    return existing.unionByName(fresh)


def replace_by(target: DataFrame, source: DataFrame, discriminator: str, processed: Sequence[str]) -> DataFrame:
    """W11 — drop every target row of the processed discriminator values, then append the
    new rows: ``(target − processed) ∪ source``. A processed value with no new rows still
    loses its old rows (T17); unprocessed values are untouched."""
    kept = target.where(~F.col(discriminator).isin(list(processed)) | F.col(discriminator).isNull())
    return kept.unionByName(source.select(*target.columns))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """W6 — keys that occur more than once, with their multiplicity."""
    keys = _list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def dedupe(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """O6 — one row per key, deterministic: greatest ``order`` tuple, then the full row."""
    out = one_per_key(df, keys, order)
    return out.drop("_src_rows")
