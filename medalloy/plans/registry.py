"""Registry of query plans (name → (spark, sf_dir) → DataFrame) and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PlanFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, PlanFn] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def plan(name: str, ops: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``ops`` lists the inventory ids it exercises."""

    def deco(fn: PlanFn) -> PlanFn:
        if name in QUERIES:
            raise ValueError(f"duplicate plan {name}")
        QUERIES[name] = fn
        OPERATORS[name] = ops
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so its plans register."""
    from medalloy.plans import (  # noqa: F401
        audit_plans, catalog_plans, conform_plans, file_plans, gold_plans, layer_plans, match_plans, metric_plans, reshape_plans,
        rollup_plans, timeseries_plans, upsert_plans,
    )
