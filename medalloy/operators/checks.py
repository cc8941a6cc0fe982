"""Integrity and data-quality checks.

Each check is a lazy DataFrame (a report); :func:`enforce` turns a report into an
assertion with one small action. Orphan checks are anti-joins (shuffle on the key, or
a size-checked broadcast of the parent).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalloy.operators.sizing import broadcast_if_small


def orphans(child: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """J8/Q5 — child rows whose key has no parent row."""
    on = [on] if isinstance(on, str) else list(on)
    return child.join(broadcast_if_small(parent.select(*on).distinct()), on, "left_anti")


def orphan_report(child: DataFrame, checks: Mapping[str, tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """Q5 — one row per FK: name and orphan count (geo and date reported separately)."""
    parts = [orphans(child, parent, on).agg(F.count(F.lit(1)).alias("orphans"))
             .select(F.lit(name).alias("fk"), "orphans") for name, (parent, on) in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """T20/W14 — key tuples that occur more than once."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def row_counts(tables: Mapping[str, DataFrame], kind: str | Mapping[str, str] = "table") -> DataFrame:
    """A13 — (kind, table_name, row_count) over several tables, one UNION ALL plan."""
    parts = []
    for name, df in tables.items():
        k = kind[name] if isinstance(kind, Mapping) else kind
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                       .select(F.lit(k).alias("kind"), F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def counts_by_name(spark: SparkSession, views: Sequence[str]) -> DataFrame:
    """S14 — row counts of registered views by one statement: the name is a session variable that
    ``IDENTIFIER`` resolves, never text pasted into the SQL."""
    spark.sql("DECLARE OR REPLACE VARIABLE scanned STRING")
    out = None
    for name in views:
        spark.sql("SET VAR scanned = :name", args={"name": name})
        part = spark.sql("SELECT count(*) AS row_count FROM IDENTIFIER(scanned)")
        part = part.select(F.lit(name).alias("table_name"), "row_count")  # the variable has moved on when the plan runs
        out = part if out is None else out.unionByName(part)
    spark.sql("DROP TEMPORARY VARIABLE scanned")
    return out


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q8 — total rows and non-null count per enrichment column (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"{c}_present") for c in columns])


def reconcile(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Q6 — counts of several frames side by side with an ``all_equal`` flag."""
    cols = [df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in counts.items()]
    first = next(iter(counts.values()))
    row = first.sparkSession.range(1).select(*cols)
    names = list(counts)
    eq = F.lit(True)
    for n in names[1:]:
        eq = eq & (F.col(n) == F.col(names[0]))
    return row.withColumn("all_equal", eq)


def conservation(total: DataFrame, parts: Mapping[str, DataFrame]) -> DataFrame:
    """Q9 — every input row is in exactly one output (e.g. silver ∪ quarantine)."""
    r = reconcile({"input_rows": total, **parts})
    s = None
    for n in parts:
        s = F.col(n) if s is None else s + F.col(n)
    return r.drop("all_equal").withColumn("conserved", F.col("input_rows") == s)


@dataclass
class CheckFailed(AssertionError):
    name: str
    detail: str

    def __str__(self) -> str:
        return f"[{self.name}] {self.detail}"


def enforce(report: DataFrame, name: str, *, max_rows: int = 0) -> None:
    """Raise if ``report`` has more than ``max_rows`` rows (one count), with their number."""
    bad = report.count()
    if bad > max_rows:
        raise CheckFailed(name, f"{bad} violating rows")
