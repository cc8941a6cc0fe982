"""Declared keys as checks (W14, Q5): every primary and foreign key in one pass.

Declarations are :class:`medalloy.store.TableSpec` rows; no check is written out by hand. Each
table is scanned once and sends, for every key it takes part in, (constraint, key, side); these are
added up per (constraint, key) with map-side combining, so that a key that a third of all rows share
is one row per task in the shuffle. All constraints share that one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.store import TableSpec


@dataclass(frozen=True)
class Constraint:
    seq: int
    name: str
    kind: str  # 'primary' or 'foreign'
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()


def dependency_order(specs: Sequence[TableSpec]) -> list[TableSpec]:
    """Parents before children, otherwise in the given order; a cycle or an undeclared parent is an error."""
    by = {s.name: s for s in specs}
    out: list[TableSpec] = []
    state: dict[str, int] = {}

    def place(s: TableSpec, path: tuple[str, ...]) -> None:
        if state.get(s.name) == 1:
            raise ValueError(f"foreign keys form a cycle: {' -> '.join((*path, s.name))}")
        if state.get(s.name) == 2:
            return
        state[s.name] = 1
        for parent, _ in s.foreign_keys.values():
            if parent not in by:
                raise ValueError(f"{s.name} refers to the undeclared table {parent}")
            if parent != s.name:
                place(by[parent], (*path, s.name))
        state[s.name] = 2
        out.append(s)

    for s in specs:
        place(s, ())
    return out


def constraints(specs: Sequence[TableSpec]) -> list[Constraint]:
    """All declared keys in the order in which they can be checked."""
    out: list[Constraint] = []
    for s in dependency_order(specs):
        if s.keys:
            out.append(Constraint(len(out) + 1, f"pk_{s.name}", "primary", s.name, tuple(s.keys)))
        for col, (parent, parent_col) in s.foreign_keys.items():
            out.append(Constraint(len(out) + 1, f"fk_{s.name}_{col}", "foreign", s.name, (col,), parent, (parent_col,)))
    return out


def _key(columns: Sequence[str]) -> Column:
    """The key as text, null if any part is null; parts carry their length, so that no two keys look alike."""
    parts = [F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")) for c in columns]
    return F.concat(*parts)


def key_counts(tables: Mapping[str, DataFrame], declared: Sequence[Constraint]) -> DataFrame:
    """(seq, key, rows, parents): rows of the constrained table and of the referred one, per constraint and key."""
    tagged: DataFrame | None = None
    for name, df in tables.items():
        tags = [F.struct(F.lit(c.seq).alias("seq"), _key(c.columns).alias("key"), F.lit(1).alias("own"), F.lit(0).alias("parent"))
                for c in declared if c.table == name]
        tags += [F.struct(F.lit(c.seq).alias("seq"), _key(c.parent_columns).alias("key"), F.lit(0).alias("own"), F.lit(1).alias("parent"))
                 for c in declared if c.parent == name]
        if not tags:
            continue
        rows = df.select(F.explode(F.array(*tags)).alias("t")).select("t.*")
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.groupBy("seq", "key").agg(F.sum("own").alias("rows"), F.sum("parent").alias("parents"))


def check_report(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> DataFrame:
    """One row per declared key: what it is, the rows checked, and the keys and rows that break it.

    A primary key is broken by a key of several rows and by a null; a foreign key by a key
    without a parent (a null refers to nothing, as in SQL, and is only counted).
    """
    declared = constraints(specs)
    first = next(iter(tables.values()))
    about = first.sparkSession.createDataFrame(
        [(c.seq, c.name, c.kind, c.table, ",".join(c.columns), f"{c.parent}({','.join(c.parent_columns)})" if c.parent else None) for c in declared],
        "seq int, constraint string, kind string, table_name string, columns string, refers_to string")  # a row per declared key
    k = key_counts(tables, declared).join(F.broadcast(about.select("seq", "kind")), "seq")
    null, own = F.col("key").isNull(), F.col("rows") > 0
    broken = F.when(F.col("kind") == "primary", own & (null | (F.col("rows") > 1))).otherwise(own & ~null & (F.col("parents") == 0))
    found = k.groupBy("seq").agg(F.sum("rows").alias("checked_rows"), F.sum(F.when(null, F.col("rows")).otherwise(0)).alias("null_rows"),
                                 F.sum(broken.cast("long")).alias("broken_keys"), F.sum(F.when(broken, F.col("rows")).otherwise(0)).alias("broken_rows"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("checked_rows", "null_rows", "broken_keys", "broken_rows")]
    return about.join(found, "seq", "left").select(*about.columns, *counts)
