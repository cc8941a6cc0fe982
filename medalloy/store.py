"""Tables as partitioned Parquet folders, written by Spark alone.

A table is the folder ``<root>/<name>``. Tables that are changed in parts are partitioned by a
``slot`` column that a row's key decides (:func:`hash_slot`, or a stable column such as the source
or the year): a write replaces the slots it holds by ``partitionOverwriteMode=dynamic`` and leaves
all other files as they are. Spark stages such a write beside the table and moves the new slots in
when the job commits. A merged slot is computed into a reliable checkpoint before it is written, so
that a load that fails while it writes can be run again.

Metrics (rows written, inserted/updated/...) come from ``DataFrame.observe`` on that same pass.
The root lives under the cluster's shared ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.operators import upsert as up
from medalloy.session import ensure_checkpoint_dir

SLOTS = 16


class DuplicateSourceKeys(AssertionError):
    pass


@dataclass(frozen=True)
class TableSpec:
    """W12 — declared table: schema (column comments in field metadata), keys, foreign keys
    (column → (table, column)); :mod:`medalloy.operators.constraints` makes checks of them."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    foreign_keys: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def comments(self) -> dict[str, str]:
        return {f.name: f.metadata.get("comment", "") for f in self.schema.fields}


def column(name: str, dtype: T.DataType, comment: str = "", nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment} if comment else {})


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """W13 — additive migration: add missing columns as typed NULLs, cast and order by the
    declared schema, with its column comments; extra columns are an error (never silently dropped)."""
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns not in the declared schema: {extra}")
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields]
    return df.select(*cols)


def hash_slot(keys: Sequence[str], slots: int = SLOTS) -> Column:
    """Slot of a key: rows of a key always meet in one slot, whatever batch they come with."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or ensure_checkpoint_dir(spark).rstrip("/") + "/medalloy-tables").rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, name: str, slots: Sequence | None = None) -> DataFrame:
        """The table, or its ``slots`` (partition pruning); the slot itself is no column of it."""
        if not self.exists(name):
            raise FileNotFoundError(f"no table {name}")
        df = self.spark.read.parquet(self.path(name))
        if slots is not None:
            df = df.where(F.col("slot").isin(list(slots)))
        return df.drop("slot")

    def files(self, name: str) -> DataFrame:
        """(slot, file_path) of the table's files."""
        return self.spark.read.parquet(self.path(name)).select("slot", F.col("_metadata.file_path").alias("file_path")).distinct()

    def _save(self, name: str, df: DataFrame, slot: Column | None, mode: str) -> None:
        w = (df if slot is None else df.withColumn("slot", slot)).write.mode(mode).option("partitionOverwriteMode", "dynamic" if slot is not None else "static")
        (w if slot is None else w.partitionBy("slot")).parquet(self.path(name))

    def write(self, name: str, df: DataFrame, *, slot: Column | None = None, metrics: Mapping[str, Column] | None = None,
              check: Callable[[dict], None] | None = None, columns: Sequence[str] | None = None) -> dict:
        """W8 — full rebuild, or with ``slot`` a rebuild of the slots that ``df`` has rows for.

        ``metrics`` are aggregates observed on ``df``; ``columns`` selects what is stored.
        ``check(metrics)`` may raise before anything is written (the rows are then computed into
        a checkpoint first).
        """
        obs = Observation(f"w_{name}_{uuid.uuid4().hex[:12]}")
        named = {"rows_written": F.count(F.lit(1)), **(metrics or {})}
        rows = df.observe(obs, *[c.alias(k) for k, c in named.items()])
        if check is not None:
            rows = cut_lineage(rows)
            check(dict(obs.get))
        self._save(name, rows if columns is None else rows.select(*columns), slot, "overwrite")
        return dict(obs.get)

    def create_if_absent(self, specs: Sequence[TableSpec]) -> dict[str, str]:
        """W12 — create every declared table that does not exist yet (no rows, the schema with its
        comments), in the given order; stop at the first error and report per table."""
        out: dict[str, str] = {}
        for s in specs:
            try:
                if not self.exists(s.name):
                    self.write(s.name, self.spark.createDataFrame([], s.schema))
                    out[s.name] = "created"
                else:
                    out[s.name] = "exists"
            except Exception as e:  # noqa: BLE001 - structured result, then stop
                out[s.name] = f"error: {e}"
                break
        return out

    def append(self, name: str, df: DataFrame, *, batch: str) -> dict:
        """W10 — append-only logs: a batch is a slot of its own, so other batches' files stay and a batch
        that is sent again takes its own place instead of adding rows. Missing columns are NULL; new
        columns need a migration first."""
        rows = conform_to(df, self.read(name).schema) if self.exists(name) else df
        return self.write(name, rows, slot=F.lit(batch))

    def upsert(self, name: str, source: DataFrame, keys: Sequence[str], *, slot: Column | None = None,
               resolve_duplicates: bool = False, **merge_kw) -> dict:
        """W1–W6 — merge ``source`` into the slots it touches (the table was written with the same
        ``slot``, by default :func:`hash_slot` of the keys); counts by change kind cover those slots. A
        batch with duplicate keys is refused before the write (W6) unless ``resolve_duplicates`` (an
        ordered load, W4: the greatest ``order`` row per key wins)."""
        slot = hash_slot(keys) if slot is None else slot
        touched = [r.slot for r in source.select(slot.alias("slot")).distinct().collect()]  # at most the table's slots
        target = self.read(name, slots=touched)
        merged = up.merge_upsert(target, source, keys, **merge_kw)
        metrics = {k: F.sum(F.when(F.col("_change") == k, 1).otherwise(0)) for k in
                   (up.INSERT, up.UPDATE, up.UNCHANGED, up.KEPT)}
        metrics["max_source_rows"] = F.max("_src_rows")

        def check(m):
            if not resolve_duplicates and (m.get("max_source_rows") or 0) > 1:
                raise DuplicateSourceKeys(f"[{name}] a key occurs {m['max_source_rows']} times in the source batch")

        return self.write(name, merged, slot=slot, metrics=metrics, check=check, columns=target.columns)

    def replace_by(self, name: str, source: DataFrame, discriminator: str, processed: Sequence[str]) -> dict:
        """W11 — replace the processed values of ``discriminator``, which is the table's slot: those with
        new rows by the write itself, those without by a slot of no rows. Other slots stay as they are."""
        schema = self.read(name).schema
        rows = conform_to(source, schema).where(F.col(discriminator).isin(list(processed)))
        done = self.write(name, rows, slot=F.col(discriminator), check=lambda m: None)
        left = set(processed) - {r[0] for r in rows.select(discriminator).distinct().collect()}  # at most the processed values
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for value in sorted(left):
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.path(name)}/{escape('slot', value)}")
        return done


def describe(store: TableStore, names: Sequence[str]) -> DataFrame:
    """W12 — (table_name, position, column_name, type, comment, present): what the written files' own
    schemas state, and the number of rows that hold each column (one pass per table)."""
    out = None
    for name in names:
        df = store.read(name)
        about = [F.struct(F.lit(name).alias("table_name"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                          F.lit(f.metadata.get("comment", "")).alias("comment"), F.col(f"n{i}").alias("present")) for i, f in enumerate(df.schema.fields, 1)]
        counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(df.schema.fields, 1)])
        rows = counts.select(F.explode(F.array(*about)).alias("c")).select("c.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
