"""Registered table queries: a Spark plan and, where SQL can say it, the same in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The tables of one folder, read lazily: ``t.orders`` is the DataFrame of ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = str(folder).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    """Register a plan under its function name."""

    def register(plan: Callable[[Tables], DataFrame]) -> Callable:
        name = plan.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, plan, dedent(sql).strip() if sql else None)
        return plan

    return register


def load_all() -> dict[str, Query]:
    """Import every query module and return the registry."""
    from shelfwright.plans import (  # noqa: F401
        change_queries,
        consumer_queries,
        document_queries,
        lineage_queries,
        reference_queries,
        report_queries,
        reshape_queries,
        rule_queries,
        search_queries,
        storage_queries,
    )

    return REGISTRY
