"""Shared helpers: Arrow batches of bounded size, reliable lineage cuts, components, digests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.session import ensure_checkpoint_dir

# Bound of the characters that a task holds as Python objects at once. One longer text is a
# slice of its own: texts are never cut.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (``spark.checkpoint.dir``): survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def send(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of any object; its class is sent by value too (see :func:`received`)."""
    return spark.sparkContext.broadcast((cloudpickle.dumps(value), {}))


def received(sent: Broadcast, make: Callable = lambda value: value):
    """``make`` of the object sent, once per Python worker: the broadcast keeps it for later tasks."""
    data, kept = sent.value
    if not kept:
        kept["made"] = make(cloudpickle.loads(data))
    return kept["made"]


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores until no column of ``df`` is called so (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, mod ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % m


def slices(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with at most ``SLICE_CHARS`` characters (or one row); null texts become ''."""
    texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
    at = chars = 0
    for i, t in enumerate(texts):
        if i > at and chars + len(t) > SLICE_CHARS:
            yield batch.slice(at, i - at), texts[at:i]
            at, chars = i, 0
        chars += len(t)
    if at < len(texts):
        yield batch.slice(at), texts[at:]


def append_columns(df: DataFrame, text_col: str, make: Callable[[], Callable[[list[str]], list]],
                   fields: list[T.StructField], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns computed from whole texts, no shuffle.

    ``make()`` runs once per task and gives a function from a list of texts to one list or
    array per field. New columns replace columns of the same name.
    """
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    read = kept if text_col in kept else [*kept, text_col]
    src = df.select(*(col(c) for c in read))
    schema = T.StructType([f for f in src.schema.fields if f.name in kept] + fields)
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part, texts in slices(batch, text_col):
                made = [pa.array(v, type=k) for v, k in zip(fn(texts), kinds, strict=True)]
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays(own + made, names=kept + names)

    return src.mapInArrow(run, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): smallest node of each connected component, for the nodes of ``edges``.

    Alternating large and small stars; each round is two aggregations and joins on plain keys,
    cut by a reliable checkpoint. Only two numbers per round reach the driver.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = cut(e)
    seen = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        e = cut(star.where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    out = e.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp")
    return out.unionByName(out.select(F.col("comp").alias("node"), "comp").distinct())


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 on uint64 (wraps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled(df: DataFrame, rows: int, key: Column, total: int) -> DataFrame:
    """At most about ``rows`` of ``total`` rows, picked by a hash of ``key`` (the same rows every run)."""
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_000)) < int(1e6 * rows / total))
