"""Lineage and checkpoint-dir rules: shared dir read from the session, reliable checkpoints."""

from pyspark.sql import functions as F

from medalloy.operators import matching as mt
from medalloy.plans import match_plans as mp
from medalloy.session import ensure_checkpoint_dir
from medalloy.sources.files import staging_path
from medalloy.store import cut_lineage


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured
    assert ensure_checkpoint_dir(spark) == configured  # never replaced once set
    assert staging_path(spark, "x").startswith(configured.rstrip("/") + "/")


def test_cut_lineage_is_a_reliable_checkpoint(spark):
    df = spark.range(100).withColumn("y", F.col("id") * 2).where("id % 3 = 0")
    cut = cut_lineage(df)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Filter" not in plan
    assert sorted(cut.collect()) == sorted(df.collect())


def test_materialised_matching_equals_lazy(spark, sf):
    def run(materialise):
        return sorted(tuple(r) for r in mt.best_match(
            mp.edited_names(spark, sf), mp.master(spark, sf), left_key="p_partkey", left_name="region_name",
            left_block="state", right_key="code", right_title="title", right_blocks="brands",
            right_names=F.array(F.col("title")), materialise=materialise).collect())

    assert run(True) == run(False)
