"""Corpus pipeline: five stages over ``documents``, each on all rows that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of ``documents``. ``ORACLE_SQL`` is None: the
stages learn models and sign texts, which SQL cannot express; tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalloy.llm import bagminhash, bpe, decontam, quality, secrets
from medalloy.llm.common import crc_mod, cut, free_name, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score 0.5 or more).

    Null and empty texts have the share of label 1 among the learnt rows as score; without any label all stay.
    """
    name = free_name(docs, "__score")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("id"), 3) != 1)
    return quality.score(docs, model, out=name).where(F.col(name) >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, the one with the smallest id (rows without an id last).

    Rows are told apart by a key of their own, not by their id. A text without words is alike
    only to the same text under the same id.
    """
    key = free_name(docs, "__key")
    keyed = cut(docs.withColumn(key, F.monotonically_increasing_id()))
    classes = bagminhash.near_duplicates(keyed, key).select(F.col("doc_id").alias(key), "class_id", "n_shingles")
    rows = keyed.select(key, "doc_id", F.xxhash64("text").alias("h")).join(classes, key)
    bare = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    rows = rows.withColumn("own", F.when(bare, F.col("doc_id"))).withColumn("cls", F.when(bare, F.col("h")).otherwise(F.col("class_id")))
    first = rows.groupBy("cls", "own").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.col(key).alias("k"))).alias("f"))
    return keyed.join(first.select(F.col("f.k").alias(key)), key, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; null and empty texts hold none."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark; ``n_chars`` follows a changed text; a null text stays null."""
    was = free_name(docs, "__was")
    clean = secrets.redact(docs.withColumn(was, F.length("text")))
    n = F.when(F.length("text") != F.col(was), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n).select(*docs.columns)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of every whole text; a null text counts as empty (no ids)."""
    import public_tokenizers

    got = bpe.encode_decode(spark, docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                            keep=["doc_id", "lang", "source"])
    return got.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", bpe_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the lineage is cut in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
