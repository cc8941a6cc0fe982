"""S11 — paged JSON: pages ``{features:[{attributes:{…}}], …}`` → one row per feature, and whether a chain of pages is whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_pages(pages: DataFrame, text_col: str, schema: T.StructType, *, array_field: str = "features",
                  item_field: str | None = "attributes") -> DataFrame:
    """Parse each page with an explicit schema (no inference), explode the feature array and
    promote the attribute fields to columns. Pages without features yield no rows."""
    parsed = pages.select(F.from_json(F.col(text_col), schema).alias("_p"))
    items = parsed.select(F.explode(F.col(f"_p.{array_field}")).alias("_f"))
    return items.select(f"_f.{item_field}.*" if item_field else "_f.*")


def read_pages(spark, path: str, schema: T.StructType, **kw) -> DataFrame:
    """Pages stored one JSON document per file."""
    pages = spark.read.text(path, wholetext=True).withColumnRenamed("value", "page")
    return flatten_pages(pages, "page", schema, **kw)


def flatten_observations(pages: DataFrame, text_col: str, fields=("date", "value", "realtime_start", "realtime_end")) -> DataFrame:
    """Series pages ``{observations:[{date, value, …}]}``: value text verbatim, absent → ''."""
    schema = T.StructType([T.StructField("observations", T.ArrayType(
        T.StructType([T.StructField(f, T.StringType()) for f in fields])))])
    items = pages.select(F.explode(F.from_json(F.col(text_col), schema)["observations"]).alias("o"))
    return items.select(*[F.coalesce(F.col(f"o.{f}"), F.lit("")).alias(f) for f in fields])


CHAIN_PAGE = T.StructType([T.StructField("features", T.ArrayType(T.StringType())), T.StructField("exceededTransferLimit", T.BooleanType())])


def chain_report(pages: DataFrame, chain_col: str, page_col: str, text_col: str) -> DataFrame:
    """One row per chain of pages (numbered from 0): is it whole?

    Every page but the last says that more follow (``exceededTransferLimit``). ``missing_pages``:
    numbers up to the last that no page has; ``repeated_pages``: pages beyond the first of a
    number; ``early_ends``: pages before the last that say no more follow; ``open_end``: the
    last page says that more follow; ``n_features``: 0 is an empty chain. Chains are aggregated, never
    sorted, so a long one is no hot group.
    """
    p = pages.select(F.col(chain_col), F.col(page_col).cast("long").alias("no"), F.from_json(F.col(text_col), CHAIN_PAGE).alias("p"))
    more = F.coalesce(F.col("p.exceededTransferLimit"), F.lit(False))
    p = p.select(chain_col, "no", F.greatest(F.coalesce(F.size("p.features"), F.lit(0)), F.lit(0)).cast("long").alias("n"), more.alias("more"))
    page = p.groupBy(chain_col, "no").agg(F.sum("n").alias("n"), F.bool_or("more").alias("more"), F.count(F.lit(1)).alias("copies"))
    c = page.groupBy(chain_col).agg(F.max("no").alias("last"), F.count(F.lit(1)).alias("numbers"), F.sum("copies").alias("n_pages"), F.sum("n").alias("n_features"),
                                    F.sum((~F.col("more")).cast("long")).alias("ends"), F.max_by("more", "no").alias("open_end"))
    early = F.col("ends") - F.when(F.col("open_end"), 0).otherwise(1)
    out = c.select(chain_col, "n_pages", "n_features", (F.col("last") + 1 - F.col("numbers")).alias("missing_pages"),
                   (F.col("n_pages") - F.col("numbers")).alias("repeated_pages"), early.alias("early_ends"), "open_end")
    whole = (F.col("missing_pages") == 0) & (F.col("repeated_pages") == 0) & (F.col("early_ends") == 0) & ~F.col("open_end") & (F.col("n_features") > 0)
    return out.withColumn("whole", whole)


class BrokenChain(ValueError):
    pass


def require_whole(report: DataFrame, chain_col: str) -> None:
    """Raise if a chain is not whole or there is none, with their number and the first."""
    seen = report.agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("whole")).cast("long")).alias("bad"), F.min(F.when(~F.col("whole"), F.col(chain_col))).alias("first")).first()
    if not seen.n or seen.bad:
        raise BrokenChain(f"{seen.bad or 0} of {seen.n} page chains are not whole, first {seen.first}")
