"""Incremental Bronze load: new files in a landing folder are upserted into a store table.

This is the streaming form of the reference's land-then-upsert loaders: a file-source
stream with an explicit all-string schema and ``trigger(availableNow=True)`` processes
every file not yet seen (tracked in the checkpoint), and ``foreachBatch`` applies the same
keyed upsert as the batch loader. A batch re-run after a failure re-applies the same
upsert, which is idempotent (see :mod:`medalloy.store`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.operators.upsert import dedupe, one_per_key
from medalloy.store import DuplicateSourceKeys, TableStore, hash_slot


def landing_stream(spark: SparkSession, path: str, columns: Sequence[str], *, fmt: str = "csv") -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.readStream.schema(schema).option("header", True).format(fmt).load(path)
                 .withColumn("source_file_path", F.col("_metadata.file_path")))


def upsert_new_files(spark: SparkSession, landing: str, columns: Sequence[str], store: TableStore, table: str,
                     keys: Sequence[str], checkpoint: str, *, transform=None, order: Sequence[str] = ()) -> list[dict]:
    """Process every unseen file once (availableNow) and return the per-batch write metrics.

    With ``order`` the greatest row of a key wins inside each batch, the first included; without
    it a batch that repeats a key is refused.
    """
    results: list[dict] = []

    def refuse_duplicates(m: dict) -> None:
        if (m.get("max_source_rows") or 0) > 1:
            raise DuplicateSourceKeys(f"[{table}] a key occurs {m['max_source_rows']} times in the first batch")

    def apply(batch: DataFrame, batch_id: int) -> None:
        b = transform(batch) if transform else batch
        if order:
            b = dedupe(b, keys, order)
        if not store.exists(table):
            results.append(store.write(table, one_per_key(b, keys), columns=b.columns, slot=hash_slot(keys),
                                       metrics={"max_source_rows": F.max("_src_rows")}, check=refuse_duplicates))
        else:
            results.append(store.upsert(table, b, keys))

    q = (landing_stream(spark, landing, columns).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return results
