"""Conform: all-string → typed with per-column cast-error capture, key resolution and the
quarantine split (Q1–Q4, J4, T1, T2, T8).

The typed frame carries one ``cast_errors`` array; the split into good and bad rows
is a single staged DataFrame with a ``quarantine_reason`` column, so both branches
come from one scan. The JSON payload of the original row is computed only for the
bad branch (``to_json(struct(*))`` defeats column pruning).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.functions.casts import (cast_error, finite, strict_double, strict_int, strict_long,
                                      strict_number_string)
from medalloy.functions.dates import date_key, month_end_from_yyyymm, safe_date
from medalloy.operators.sizing import broadcast_if_small


@dataclass(frozen=True)
class ColumnSpec:
    """How to type one raw string column.

    kind: ``double`` | ``long`` | ``int`` | ``string`` | ``date`` (yyyy-MM-dd) |
    ``yyyymm`` (month → month-end DATE). ``key=True`` marks a column whose null
    result rejects the row even when the raw text was blank (T8).
    """

    name: str
    kind: str = "double"
    source: str | None = None
    key: bool = False
    checked: bool = True

    @property
    def raw(self) -> str:
        return self.source or self.name


def typed_expr(raw: Column, kind: str) -> Column:
    if kind == "double":
        return strict_double(raw)
    if kind == "long":
        return strict_long(raw)
    if kind == "int":
        return strict_int(raw)
    if kind == "string":
        return F.trim(raw)
    if kind == "date":
        return safe_date(F.trim(raw), "yyyy-MM-dd")
    if kind == "yyyymm":
        return month_end_from_yyyymm(raw)
    raise ValueError(f"unknown kind {kind!r}")


def _staged_numeric(kind: str, text: Column, parsed: Column) -> Column:
    if kind == "long":
        return F.round(parsed).try_cast("long")
    if kind == "int":
        return F.round(parsed).try_cast("int")
    return parsed


def type_columns(df: DataFrame, specs: Sequence[ColumnSpec], *, keep: Sequence[str] = (),
                 errors_col: str = "cast_errors", as_array: bool = True) -> DataFrame:
    """Q1 — typed columns plus ``cast_errors``: names of columns whose reported value
    (non-null, non-blank) failed to type; a key column fails on any null result.

    Staged projections so each pattern match / parse runs once per value, and no
    higher-order function (which would drop the projection out of whole-stage codegen):
    the error list is a ``concat_ws`` string, split into an array at the end.
    """
    n = len(specs)
    raw = [F.col(s.raw).alias(f"_r{i}") for i, s in enumerate(specs)]
    # 1) pattern match once: numeric text or NULL
    s1 = df.select(*keep, *raw, *[
        (strict_number_string(F.col(s.raw)) if s.kind in ("double", "long", "int") else F.lit(None).cast("string"))
        .alias(f"_n{i}") for i, s in enumerate(specs)])
    # 2) parse once
    s2 = s1.select(*keep, *[f"_r{i}" for i in range(n)], *[
        (finite(F.col(f"_n{i}").try_cast("double")) if s.kind in ("double", "long", "int")
         else F.lit(None).cast("double")).alias(f"_p{i}") for i, s in enumerate(specs)])
    # 3) final typed values
    typed = []
    for i, s in enumerate(specs):
        if s.kind in ("double", "long", "int"):
            typed.append(_staged_numeric(s.kind, F.col(f"_r{i}"), F.col(f"_p{i}")).alias(f"_t{i}"))
        else:
            typed.append(typed_expr(F.col(f"_r{i}"), s.kind).alias(f"_t{i}"))
    s3 = s2.select(*keep, *[f"_r{i}" for i in range(n)], *typed)
    # 4) errors from raw vs typed (references only)
    errs = []
    for i, s in enumerate(specs):
        if not s.checked:
            continue
        bad = F.col(f"_t{i}").isNull() if s.key else cast_error(F.col(f"_r{i}"), F.col(f"_t{i}"))
        errs.append(F.when(bad, F.lit(s.name)))
    err_text = F.concat_ws(",", *errs) if errs else F.lit("")
    s4 = s3.select(*keep, *[F.col(f"_t{i}").alias(s.name) for i, s in enumerate(specs)], err_text.alias("_e"))
    if not as_array:
        return s4.withColumnRenamed("_e", errors_col)
    arr = F.when(F.col("_e") == "", F.array().cast("array<string>")).otherwise(F.split(F.col("_e"), ","))
    return s4.select(*keep, *[s.name for s in specs], arr.alias(errors_col))


def sentinel_reason(date_raw: Column, value_raw: Column, *, date_name: str = "observation_date",
                    value_name: str = "value", missing: str = ".") -> Column:
    """Q2 — ordered rejection of a series row: bad date, then the missing-value sentinel
    (exact text), then a reported (non-blank) value that is not a number; NULL when the row
    is good. A blank value is "not reported", not an error."""
    d = safe_date(F.trim(date_raw), "yyyy-MM-dd")
    return (F.when(d.isNull(), F.lit(f"cast_failed:{date_name}"))
             .when(value_raw == F.lit(missing), F.lit("null_value"))
             .when(cast_error(value_raw, strict_double(value_raw)), F.lit(f"cast_failed:{value_name}")))


def resolve_key(df: DataFrame, dim: DataFrame, on: str | Sequence[str], key: str, *,
                max_broadcast_bytes: int | None = None) -> DataFrame:
    """J4 — left join ``dim[on → key]``; NULL ``key`` marks an unmatched row.

    The dimension is broadcast only when Catalyst's size estimate is under the bound;
    otherwise the join stays a shuffle join that AQE may still convert at run time.
    """
    on = [on] if isinstance(on, str) else list(on)
    d = dim.select(*on, key)
    d = broadcast_if_small(d) if max_broadcast_bytes is None else broadcast_if_small(d, max_broadcast_bytes)
    return df.join(d, on, "left")


def quarantine_reason(*, key_col: str | None = None, errors_col: str = "cast_errors",
                      unmatched: str = "unmatched_geography") -> Column:
    """Q3 — reason precedence: unmatched key first, else ``cast_failed:a,b``, else NULL."""
    cast_part = F.when(F.size(errors_col) > 0, F.concat(F.lit("cast_failed:"), F.concat_ws(",", errors_col)))
    if key_col is None:
        return cast_part
    return F.when(F.col(key_col).isNull(), F.lit(unmatched)).otherwise(cast_part)


def natural_key(cols: Sequence[str], sep: str = "|") -> Column:
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def _keep_if(df: DataFrame, cond: Column) -> DataFrame:
    """Rows where ``cond`` holds, as a one-element generator instead of a Filter: a Filter
    would be pushed below the staged typing projections with every alias inlined, which
    re-evaluates the whole pattern/parse tree per row; a Generate is not pushed down."""
    return df.select("*", F.explode(F.when(cond, F.array(F.lit(True)))).alias("_keep")).drop("_keep")


def split(staged: DataFrame, reason_col: str = "quarantine_reason") -> tuple[DataFrame, DataFrame]:
    """Good rows (no reason) and bad rows; good ∪ bad = input, by construction."""
    return (_keep_if(staged, F.col(reason_col).isNull()), _keep_if(staged, F.col(reason_col).isNotNull()))


def quarantine_rows(bad: DataFrame, *, source_system: str, natural_key_cols: Sequence[str],
                    payload: Column, reason_col: str = "quarantine_reason",
                    source_file_col: str | None = None) -> DataFrame:
    """Shape rejected rows as quarantine records. ``payload`` is a struct of the original
    row (capture it before typing); it is serialised with null fields kept."""
    return bad.select(
        F.lit(source_system).alias("source_system"),
        (F.col(source_file_col) if source_file_col else F.lit(None).cast("string")).alias("source_file_path"),
        natural_key(natural_key_cols).alias("natural_key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("raw_payload"),
        F.col(reason_col).alias("quarantine_reason"),
    )


def with_date_key(df: DataFrame, date_col: str, out: str = "date_key") -> DataFrame:
    return df.withColumn(out, date_key(date_col))
