"""Named-query catalog: run all or selected analyses, export one CSV per
query and a JSON manifest.

Queries are registered in Python as (name, description, builder) where the
builder returns a DataFrame (DataFrame API or ``spark.sql``). Row counts
come from ``observe()`` on the write itself, so no query runs twice.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SAFE_NAME = re.compile(r"^[A-Za-z0-9_]+$")


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Callable[[SparkSession], DataFrame]
    description: str = ""

    def __post_init__(self):
        if not SAFE_NAME.match(self.name):
            raise ValueError(f"unsafe query name {self.name!r}: use letters, digits and _")


@dataclass(frozen=True)
class AnalysisResult:
    name: str
    description: str
    output_path: str
    rows: int
    columns: int
    column_names: list


def sql_query(name: str, sql: str, description: str = "") -> NamedQuery:
    return NamedQuery(name, lambda spark: spark.sql(sql), description)


def validate_catalog(queries: Sequence[NamedQuery]) -> None:
    seen = set()
    for q in queries:
        if q.name in seen:
            raise ValueError(f"duplicate query name {q.name!r}")
        seen.add(q.name)


def select_queries(queries: Sequence[NamedQuery], requested: Sequence[str] | None = None) -> list[NamedQuery]:
    """All queries, or the requested ones in catalog order; unknown or
    repeated names are errors."""
    validate_catalog(queries)
    if not requested:
        return list(queries)
    if len(set(requested)) != len(requested):
        raise ValueError(f"duplicate requested names: {list(requested)}")
    known = {q.name for q in queries}
    unknown = sorted(set(requested) - known)
    if unknown:
        raise ValueError(f"unknown query names: {unknown}")
    wanted = set(requested)
    return [q for q in queries if q.name in wanted]


def export_query(spark: SparkSession, q: NamedQuery, output_dir: str) -> AnalysisResult:
    """Run one query and write ``<name>`` (CSV with header)."""
    df = q.build(spark)
    obs = Observation(f"rows_{q.name}")
    path = os.path.join(output_dir, q.name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    rows = obs.get.get("rows", 0)
    return AnalysisResult(q.name, q.description, path, int(rows), len(df.columns), list(df.columns))


def run_analyses(
    spark: SparkSession,
    queries: Sequence[NamedQuery],
    output_dir: str,
    requested: Sequence[str] | None = None,
    required_tables: Sequence[str] = (),
    parallelism: int = 1,
) -> list[AnalysisResult]:
    """Run the selected queries; results come back in catalog order and a
    failure is re-raised naming the query. Required tables must exist
    first. ``parallelism`` > 1 submits queries from that many driver threads
    so Spark runs their jobs concurrently (use the FAIR scheduler to share
    executors between them)."""
    missing = [t for t in required_tables if not spark.catalog.tableExists(t)]
    if missing:
        raise ValueError(f"required tables missing: {missing}")
    selected = select_queries(queries, requested)

    def run(q: NamedQuery) -> AnalysisResult:
        try:
            return export_query(spark, q, output_dir)
        except Exception as exc:  # noqa: BLE001
            raise RuntimeError(f"query {q.name!r} failed: {exc}") from exc

    if parallelism <= 1:
        return [run(q) for q in selected]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(run, selected))


def manifest(results: Sequence[AnalysisResult], output_dir: str, source: str = "") -> dict:
    return {"created_utc": _dt.datetime.now(_dt.UTC).isoformat(), "source": source, "output_directory": output_dir,
            "query_count": len(results), "queries": [asdict(r) for r in results]}


def save_manifest(results: Sequence[AnalysisResult], output_dir: str, source: str = "",
                  spark: SparkSession | None = None) -> str:
    """Manifest JSON (query metadata only, a few KB) next to the outputs,
    written through the output folder's filesystem."""
    from strata.sources.io import write_text_file
    spark = spark or SparkSession.getActiveSession()
    path = os.path.join(output_dir, "analysis_manifest.json")
    return write_text_file(spark, path, json.dumps(manifest(results, output_dir, source), indent=2))


def summary_frame(spark: SparkSession, results: Sequence[AnalysisResult]) -> DataFrame:
    return spark.createDataFrame([(r.name, r.rows, r.columns, r.output_path) for r in results],
                                 "name string, rows long, columns long, output_path string")
