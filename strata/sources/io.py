"""File and table I/O.

CSV is read with a declared schema (no inference pass) and ``escape='"'``
so quoted fields with commas, quotes and line breaks parse; Parquet keeps column pruning and
predicate pushdown. Writers never collect: they write partitioned files.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem of the path (works for
    local paths and cluster storage alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def write_text_file(spark: SparkSession, path: str, text: str) -> str:
    """Write one small text file (a manifest, a metadata document) through
    the Hadoop filesystem of ``path``: local disk, HDFS or object stores."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return path


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, *, header: bool = True,
             reject_empty: bool = True, name: str = "dataset", multi_line: bool = True,
             malformed: str = "null", max_examples: int = 10) -> DataFrame:
    """CSV with header; missing file -> FileNotFoundError; empty -> ValueError.

    Without a schema every column is read as text (callers standardize
    types explicitly); inference would cost an extra pass over the data.
    Quoted fields may hold line breaks, so a file is read by one task; where
    none does, ``multi_line=False`` lets Spark split files.

    ``malformed`` says what becomes of a line with too few or too many fields,
    or a field that its column's type cannot hold: ``null`` leaves nulls,
    ``report`` also keeps the line's text in a ``_corrupt_record`` column, and
    ``fail`` raises with the number of such lines and a few of them (one more
    pass over the file)."""
    if malformed not in ("null", "report", "fail"):
        raise ValueError("malformed must be null, report or fail")
    if not _exists(spark, path):
        raise FileNotFoundError(f"{name} file not found: {path}")
    reader = spark.read.option("header", header).option("escape", '"').option("multiLine", multi_line)
    if malformed != "null":
        if schema is None:
            schema = reader.csv(path).schema  # the header's names
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        schema = StructType([*fields.fields, StructField(CORRUPT, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    if malformed == "fail":
        # all columns are asked for: a line is only found short where its last fields are wanted
        used = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != CORRUPT])
        n = df.agg(F.count(CORRUPT).alias("n"), F.bit_xor(used)).first().n
        if n:
            found = df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, used).limit(max_examples).collect()
            raise ValueError(f"{name} has {n} malformed lines: {[r[CORRUPT] for r in found]}")
        df = df.drop(CORRUPT)
    if reject_empty and df.isEmpty():
        raise ValueError(f"{name} is empty: {path}")
    return df


def read_parquet(spark: SparkSession, path: str, name: str = "dataset") -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(f"{name} file not found: {path}")
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """CSV that ``read_csv`` gives back as it was: quotes doubled, line breaks
    inside quotes, blanks at the ends kept. (Empty texts are read as nulls, as in
    any CSV without a marker for nulls.)"""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


SUPPORTED = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """Read by extension (.csv / .parquet / .pq). Unsupported types raise
    instead of silently yielding an empty table."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in SUPPORTED:
        raise ValueError(f"unsupported table type {ext!r} for {path}")
    if SUPPORTED[ext] == "csv":
        return read_csv(spark, path, reject_empty=False)
    return read_parquet(spark, path)


_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, name: str, if_exists: str = "replace", *, temporary: bool = False,
                path: str | None = None) -> None:
    """Register ``df`` as table ``name``: replace / append / fail. With
    ``temporary`` it becomes a session view (replace only); ``path`` puts a new
    table's files into a folder of yours instead of the warehouse."""
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}")
    if temporary:
        if if_exists != "replace":
            raise ValueError("temporary views only support if_exists='replace'")
        df.createOrReplaceTempView(name)
        return
    writer = df.write.mode(_MODES[if_exists])
    (writer.option("path", path) if path else writer).saveAsTable(name)


def split_statements(script: str) -> list[str]:
    """Statements of a script: ``--`` comment lines dropped, split on ``;``."""
    lines = [ln for ln in script.splitlines() if not ln.strip().startswith("--")]
    return [s.strip() for s in "\n".join(lines).split(";") if s.strip()]


def execute_script(spark: SparkSession, script: str) -> int:
    """Run each statement (e.g. DROP/CREATE VIEW); returns the count."""
    statements = split_statements(script)
    for stmt in statements:
        spark.sql(stmt)
    return len(statements)


def query(spark: SparkSession, sql: str, parameters: Sequence | Mapping | None = None) -> DataFrame:
    """SQL with positional (``?``) or named (``:name``) parameters bound
    as literals by Spark (no string formatting)."""
    if parameters is None:
        return spark.sql(sql)
    return spark.sql(sql, args=list(parameters) if not isinstance(parameters, Mapping) else dict(parameters))


def list_objects(spark: SparkSession) -> DataFrame:
    """(name, type) of tables and views in the current database, system
    objects hidden, ordered by type then name."""
    rows = [(t.name, "view" if t.tableType in ("VIEW", "TEMPORARY") else "table")
            for t in spark.catalog.listTables() if not t.name.startswith("_")]
    df = spark.createDataFrame(rows, "name string, type string")
    return df.orderBy(F.col("type"), F.col("name"))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
