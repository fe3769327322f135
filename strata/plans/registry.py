"""Registry of testbed queries: each name maps to a Spark builder
``(spark, sf_dir) -> DataFrame`` and, when SQL can express it, an
equivalent DuckDB SQL text over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.session import table_path

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    build: Builder
    oracle: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}


def register(name: str, operators: str = "", oracle: str | None = None):
    """Decorator adding a builder to the registry under ``name``."""

    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name!r}")
        REGISTRY[name] = Registered(name, fn, oracle, tuple(operators.split()))
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
