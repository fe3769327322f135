"""Row filters and column arrangement.

A ``FilterSpec`` folds into one Column conjunction, so Catalyst pushes the
comparable parts (IN lists, ranges on plain columns) into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strata.functions.exprs import family_size


def isin_text(column: str, values: Sequence) -> Column:
    """Value (as text) in the list; an empty list means no filter."""
    if not values:
        return F.lit(True)
    return F.col(column).cast("string").isin([str(v) for v in values])


def in_range(column: str, lo: float, hi: float, numeric: bool = False) -> Column:
    """Inclusive numeric range; nulls fail. A ``numeric`` column is compared as
    it is, so that the range reaches the scan; else the value is leniently parsed."""
    if numeric:
        return F.col(column).between(F.lit(lo), F.lit(hi)) & F.col(column).isNotNull()
    v = F.col(column).cast("string").try_cast("double")
    return v.between(F.lit(lo), F.lit(hi)) & v.isNotNull()


def presence_status(df: DataFrame, flag: str, source: str) -> Column:
    """0/1 presence with fallbacks: the flag column (null -> 0), else the
    source column's non-null test, else constant 0."""
    if flag in df.columns:
        return F.coalesce(F.col(flag).cast("string").try_cast("double"), F.lit(0.0)).cast("int")
    if source in df.columns:
        return F.col(source).isNotNull().cast("int")
    return F.lit(0)


def group_size(df: DataFrame, size: str, parts: Sequence[str]) -> Column:
    """Group size from a size column (null -> 1) or 1 + sum of parts."""
    if size in df.columns:
        return F.coalesce(F.col(size).cast("string").try_cast("double"), F.lit(1.0))
    present = [p for p in parts if p in df.columns]
    return family_size(*present).cast("double")


@dataclass
class FilterSpec:
    """Composite filter: every part is optional and they are AND-ed.

    ``isin``: column -> accepted values (compared as text, empty = all).
    ``ranges``: column -> (lo, hi) inclusive on the numeric value.
    ``presence``: (flag, source, wanted 0/1) presence test with fallbacks.
    ``group``: (size column, part columns, "alone" | "group").
    """

    isin: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    presence: tuple[str, str, int] | None = None
    group: tuple[str, Sequence[str], str] | None = None

    def condition(self, df: DataFrame) -> Column:
        parts = [isin_text(c, v) for c, v in self.isin.items() if c in df.columns and v]
        parts += [in_range(c, lo, hi, isinstance(df.schema[c].dataType, NumericType)) for c, (lo, hi) in self.ranges.items() if c in df.columns]
        if self.presence is not None:
            flag, source, wanted = self.presence
            parts.append(presence_status(df, flag, source) == F.lit(wanted))
        if self.group is not None:
            size, members, mode = self.group
            g = group_size(df, size, members)
            parts.append(g == 1 if mode == "alone" else g > 1)
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return df.filter(spec.condition(df))


def literal_search(df: DataFrame, term: str, columns: Sequence[str]) -> DataFrame:
    """Rows where any chosen column contains ``term`` (case-insensitive,
    literal, not a pattern). Blank term -> all rows."""
    if not term or not term.strip() or not columns:
        return df
    needle = F.lit(term.lower())
    cond = reduce(lambda a, b: a | b,
                  [F.coalesce(F.contains(F.lower(F.col(c).cast("string")), needle), F.lit(False)) for c in columns])
    return df.filter(cond)


def row_search(df: DataFrame, term: str) -> DataFrame:
    """Rows whose space-joined text of all columns contains ``term``
    (case-insensitive literal)."""
    if not term or not term.strip():
        return df
    text = F.concat_ws(" ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    return df.filter(F.contains(F.lower(text), F.lit(term.lower())))


def reorder_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Preferred columns first (those present, in the given order), then
    the rest in their current order."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_aliased(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``SELECT a AS b, ...`` for the mapped columns."""
    return df.select(*[F.col(k).alias(v) for k, v in mapping.items()])


def unpivot_values(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable",
                   value: str = "value", labels: Mapping[str, str] | None = None) -> DataFrame:
    """Wide -> long (``melt``), null values dropped, variables relabelled."""
    long = df.unpivot(list(ids), list(values), variable, value).filter(F.col(value).isNotNull())
    if labels:
        from strata.functions.exprs import recode
        long = long.withColumn(variable, F.coalesce(recode(variable, labels), F.col(variable)))
    return long
