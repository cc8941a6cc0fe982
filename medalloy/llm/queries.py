"""Registered queries of the operators; the digest columns are derived here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalloy.llm import (
    bagminhash, bpe, centroid_walk, decontam, html_extract, langid, periodic_runs, pivot_search, quality, secrets, stable_ann, toxicity,
    url_rules,
)
from medalloy.llm.common import crc_mod, table


def op1_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_cgk_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item whose passage it holds; clean documents have none."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pivot_search.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return pivot_search.top_k(rows.where(F.col("vec_id") % 50 == 0), rows, k=5)


def op4_bagminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class of near duplicates (smallest id) and its class of equal words."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    learnt = langid.learn(docs, ~held_out)
    return langid.predict(docs, learnt, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans; code points, ends exclusive."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count("random"))


def op7_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("id"), 3) != 1)
    return _judged(quality.score(docs, model, keep=["doc_id"]), crc_mod(F.col("doc_id"), 3) == 1)


def op10_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("id"), 5) != 0)
    return _judged(toxicity.score(docs, model, keep=["doc_id"]), crc_mod(F.col("doc_id"), 5) == 0)


def _judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = bpe.encode_decode(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=["doc_id"])
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), keep=["page_id"])


def op11_stable_projection_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stable_ann.valid_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return stable_ann.neighbours(rows.where(F.col("vec_id") % 100 == 0), rows, k=10)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by a hash of the id, the words from some word on repeat a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"))).alias("w"))
    docs = docs.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), tail)
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, longest run and digests of each document's runs."""
    found = periodic_runs.detect(with_planted_runs(table(spark, sf_dir, "documents")), keep=["doc_id"])
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("m"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    found = found.withColumn("top", top)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.m").alias("length"),
                        (-F.col("top.q")).alias("period"), F.expr("1000 * top.m div -top.q").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_centroid_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroid_walk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", dims=64, scale=64)
    assigned, centroids = centroid_walk.cluster(vectors, k=16, rounds=3, salt="1:")
    return centroid_walk.with_inertia(assigned, centroids)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_style_tree_text": op1_style_tree_text,
    "op2_cgk_leaks": op2_cgk_leaks,
    "op3_pivot_topk": op3_pivot_topk,
    "op4_bagminhash_classes": op4_bagminhash_classes,
    "op5_cross_parsing_language": op5_cross_parsing_language,
    "op6_secret_scan": op6_secret_scan,
    "op7_kernel_quality": op7_kernel_quality,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_url_rules": op9_url_rules,
    "op10_boosted_toxicity": op10_boosted_toxicity,
    "op11_stable_projection_ann": op11_stable_projection_ann,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_centroid_walk": op13_centroid_walk,
}

ORACLES: dict[str, str] = {
    "op3_pivot_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select distinct vec_id, v from v where vec_id % 50 = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from q join v c on q.vec_id is distinct from c.vec_id and len(q.v) = len(c.v))
select query_id, row_number() over (partition by query_id order by score desc, vec_id nulls last)::int as rank, vec_id, score
from s qualify rank <= 5""",
    "op9_url_rules": url_rules.ORACLE,
    "op13_centroid_walk": centroid_walk.CLUSTER_SQL,
}
