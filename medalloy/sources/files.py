"""File scans with contracts.

Everything is one distributed pass over all files: headers are read as the first line
of every file in a single text scan (not a driver loop of ``limit(0)`` reads), file
names are mapped to series ids by a join to the manifest, and ragged per-station CSVs
are cut into quoted fields and looked up by header name with built-in functions.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.operators.sizing import broadcast_if_small
from medalloy.session import ensure_checkpoint_dir

BOM = "\ufeff"

def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint dir (never a machine-local one)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/medalloy-staging/{name}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------- S1–S5


def read_csv_all_string(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S1 — header row, no inference: every column is STRING (codes keep leading zeros)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_csv_positional(spark: SparkSession, path: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    """S2 — explicit all-STRING schema applied by position; the file's header row is skipped
    (pair with :func:`header_report` to guard the header)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
                 .option("mode", "PERMISSIVE").csv(path))


def read_csv_exact(spark: SparkSession, path: str | Sequence[str], header: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """S2/S6 — all-STRING scan of files whose header must be ``header``, in order: the reader compares each
    file's first line in the load's own pass and the load fails at a file that differs. ``names``
    renames the columns by position."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return df.toDF(*names) if names else df


def clean_name(name: str) -> str:
    return name.strip().lower().replace("-", "_").replace(" ", "_")


def select_subset(df: DataFrame, wanted: Sequence[str], *, rename: Mapping[str, str] | None = None) -> DataFrame:
    """S3 — keep the wanted columns by name (back-tick quoted, so names with ``-`` work) and
    rename to clean lower-case names. Missing wanted columns raise."""
    missing = [w for w in wanted if w not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    rename = rename or {}
    return df.select(*[F.col(f"`{w}`").alias(rename.get(w, clean_name(w))) for w in wanted])


def with_provenance(df: DataFrame, run_id: str, *, literal_path: str | None = None) -> DataFrame:
    """S5 — source file path (from ``_metadata``), insert timestamp and run id."""
    path = F.lit(literal_path) if literal_path else F.col("_metadata.file_path")
    return df.select("*", path.alias("source_file_path"), F.current_timestamp().alias("inserted_ts"),
                     F.lit(run_id).alias("run_id"))


def file_basename(path_col: Column) -> Column:
    return F.regexp_extract(path_col, r"([^/]+)$", 1)


# --------------------------------------------------------------------------- S6


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file_path, first_line) of every file, from one text scan: the first line of a file is
    the lowest-ordered row of the split that starts at byte 0."""
    t = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_row"))
    return (t.where(F.col("_blk") == 0).groupBy("file_path")
             .agg(F.min_by("value", "_row").alias("first_line")))


def header_tokens(line: Column, sep: str = ",") -> Column:
    """Header line → trimmed column names (BOM and surrounding quotes removed)."""
    clean = F.regexp_replace(line, "^" + BOM, "")
    return F.transform(F.split(clean, sep), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))


def header_report(spark: SparkSession, path: str | Sequence[str], expected: Sequence[str], *,
                  mode: str = "exact", sep: str = ",") -> DataFrame:
    """S6 — one row per file: file_path, header array, ok flag and the missing columns.

    mode="exact": the header equals ``expected`` in order; mode="subset": every expected
    name is present. A caller reports all bad files, then raises (no files → no rows).
    """
    fl = first_lines(spark, path).withColumn("header", header_tokens(F.col("first_line"), sep))
    exp = F.array(*[F.lit(c) for c in expected])
    missing = F.array_except(exp, F.col("header"))
    ok = (F.col("header") == exp) if mode == "exact" else (F.size(missing) == 0)
    return fl.select("file_path", "header", ok.alias("ok"), missing.alias("missing"))


# --------------------------------------------------------------------------- S7


def manifest_lookup(df: DataFrame, manifest: DataFrame, *, path_col: str = "source_file_path",
                    file_col: str = "file_name", id_col: str = "series_id") -> DataFrame:
    """S7 — file basename → id from a manifest; rows of unknown files get a NULL id
    (report them with ``where(id IS NULL)`` and fail the load)."""
    m = broadcast_if_small(manifest.select(F.col(file_col).alias("_file"), id_col))
    return df.withColumn("_file", file_basename(F.col(path_col))).join(m, "_file", "left").drop("_file")


# --------------------------------------------------------------------------- S10


# A record is a line, but for line ends inside quotes; a field follows a comma.
_RECORD = r'((?:[^"\r\n]|"(?:[^"]|"")*(?:"|$))+)'
_FIELD = r',("(?:[^"]|"")*"[^,]*|[^,]*)'


def csv_fields(record: Column) -> Column:
    """The fields of one CSV record, unquoted and trimmed; blank ones are NULL."""
    cut = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD))

    def plain(x: Column) -> Column:
        inner = F.replace(F.regexp_extract(x, r'(?s)^"((?:[^"]|"")*)"', 1), F.lit('""'), F.lit('"'))
        return F.nullif(F.trim(F.when(x.startswith('"') & x.rlike(r'(?s)^"(?:[^"]|"")*"'), inner).otherwise(x)), F.lit(""))

    return F.transform(cut, plain)


def parse_ragged(files: DataFrame, columns: Sequence[str], *, id_col: str, keep_prefix: str | None = None,
                 content_col: str = "content", path_col: str = "file_path") -> DataFrame:
    """S10/P8 — per-file CSVs whose headers differ (hundreds to thousands of columns): the wanted
    ``columns`` are looked up by header name (missing or blank → NULL; of two columns of one name
    the first), ids starting with ``keep_prefix`` are kept. Quoted commas, line ends and doubled
    quotes are read as in CSV. A file without a header or without records gives no rows; see
    :func:`require_rows` for loads that must not be empty."""
    content = F.regexp_replace(F.col(content_col), "^" + BOM, "")
    records = files.select(F.col(path_col).alias("source_file_path"), F.regexp_extract_all(content, F.lit(_RECORD)).alias("r")).where(F.size("r") > 1)
    rows = records.select("source_file_path", csv_fields(F.get("r", F.lit(0))).alias("h"), F.explode(F.slice("r", F.lit(2), F.size("r"))).alias("rec"))
    rows = rows.select("source_file_path", "h", csv_fields(F.col("rec")).alias("v"))
    out = rows.select(*[F.get("v", F.array_position("h", F.lit(c)).cast("int") - 1).alias(c) for c in columns], "source_file_path")
    return out.where(F.col(f"`{id_col}`").startswith(keep_prefix)) if keep_prefix is not None else out


class NoRows(ValueError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself; raises if it has no rows (the probe stops at the first)."""
    if df.isEmpty():
        raise NoRows(f"{what}: no rows")
    return df


def ragged_csv(spark: SparkSession, path: str, columns: Sequence[str], *, id_col: str,
               keep_prefix: str | None = None) -> DataFrame:
    """S10 over a directory of small CSV files (``wholetext``: one row per file)."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("content"))
    return parse_ragged(files, columns, id_col=id_col, keep_prefix=keep_prefix)


# --------------------------------------------------------------------------- S12, S13


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as rows: path, length, content, sha256."""
    b = spark.read.format("binaryFile").load(path)
    return b.select("path", "length", "content", F.sha2(F.col("content"), 256).alias("file_sha256"))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """S12 — what lies in a landing folder: (path, length, modified) of every file, without its content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def changed_files(candidates: DataFrame, last: DataFrame, *, source_col: str = "source_url",
                  sha_col: str = "file_sha256", exists_col: str = "landed_exists") -> DataFrame:
    """S12 — skip a file iff its hash equals the latest succeeded hash of the same source
    *and* the landed copy still exists; otherwise land it."""
    j = candidates.join(broadcast_if_small(last), source_col, "left")
    same = F.col(sha_col).eqNullSafe(F.col("last_sha256")) & F.col("last_sha256").isNotNull()
    skip = same & F.coalesce(F.col(exists_col), F.lit(False))
    return j.withColumn("decision", F.when(skip, "skipped").otherwise("land"))


def acceptance_reason(content: Column, length: Column, declared_size: Column, fmt: Column,
                      expected_header: Column) -> Column:
    """S13 — first failing check wins: empty; size differs from declared; for CSV only, the
    header's columns (BOM stripped) must begin with the expected columns; else NULL (accepted)."""
    first = F.regexp_replace(F.substring_index(F.decode(content, "UTF-8"), "\n", 1), r"\r$", "")
    expected = header_tokens(expected_header)
    begins = F.slice(header_tokens(first), 1, F.size(expected)) == expected
    return (F.when(length == 0, F.lit("empty"))
             .when(declared_size.isNotNull() & (length != declared_size), F.lit("size_mismatch"))
             .when((fmt == "csv") & expected_header.isNotNull() & ~begins,
                   F.lit("header_mismatch")))


# --------------------------------------------------------------------------- S15


# US state and DC postal codes accepted by the station inventory parse.
US_STATES = ("AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA",
             "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX",
             "UT", "VT", "VA", "WA", "WV", "WI", "WY")


def parse_inventory(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S15 — whitespace-separated ``station lat lon elev state name…``: first five tokens only
    (names contain spaces), lines with fewer than five tokens skipped, US states + DC kept."""
    tok = F.split(F.trim(F.col(value_col)), r"\s+", 6)
    staged = lines.select(tok.alias("t")).where(F.size("t") >= 5)
    out = staged.select(
        F.col("t")[0].alias("station"),
        F.col("t")[1].try_cast("double").alias("latitude"),
        F.col("t")[2].try_cast("double").alias("longitude"),
        F.col("t")[4].alias("state"))
    return out.where(F.col("state").isin(*US_STATES))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return parse_inventory(spark.read.text(path))


# --------------------------------------------------------------------------- S4, A1


class ColumnContractError(ValueError):
    pass


def read_parquet_contract(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """S4 — Parquet scan whose column list must equal ``columns`` exactly (schema metadata
    only; no data is read to check it)."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if list(df.columns) != list(columns):
        raise ColumnContractError(f"expected columns {list(columns)}, found {df.columns}")
    return df


def file_inventory(df: DataFrame) -> DataFrame:
    """A1 — rows and distinct source files of a file-backed DataFrame, in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(F.col("_metadata.file_path")).alias("n_files"))


class HeaderContractError(ValueError):
    pass


def enforce_headers(report: DataFrame) -> str:
    """S6 — ``'ok'``, or ``'no_files'`` when nothing matched the path; otherwise raise with the
    number of bad files, an example and its missing columns (``report`` itself lists them all)."""
    seen = report.agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("ok")).cast("long")).alias("bad"),
                      F.min(F.when(~F.col("ok"), F.struct("file_path", "missing"))).alias("first")).first()
    if not seen.n:
        return "no_files"
    if seen.bad:
        raise HeaderContractError(f"header contract failed in {seen.bad} of {seen.n} files, first {seen.first.file_path} "
                                  f"(missing {list(seen.first.missing)})")
    return "ok"


def enforce_manifest(mapped: DataFrame, id_col: str = "series_id", path_col: str = "source_file_path") -> None:
    """S7 — raise if any file is not in the manifest, with the number of such files and the first."""
    unknown = mapped.where(F.col(id_col).isNull()).agg(F.countDistinct(path_col).alias("n"), F.min(path_col).alias("first")).first()
    if unknown.n:
        raise ValueError(f"{unknown.n} files not in the manifest, first {unknown.first}")
