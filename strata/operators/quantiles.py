"""Exact quantiles (linear interpolation, as pandas/numpy and Spark's
``percentile``) without sorting values or gathering a group in one task.

``percentile``/``median`` merge a value->count map of every distinct value
into a single task per group, which does not scale to a hot group or a
high-cardinality column. Here the wanted ranks are narrowed by radix, at every
size. A first aggregate counts the values in cells of their leading bits (sign,
exponent and the first ten of the mantissa), all columns and groups together;
running sums over the cells tell which cell holds each wanted rank. A cell whose
least and greatest value are equal gives its rank's value; the others are cut
into 65,536 parts and counted again, until none is left (a double has no bits
for more than three such rounds; two-decimal amounts take one). Only counts of
cells are shuffled; few cells are looked through as local rows. ``accuracy`` switches to ``percentile_approx`` (one pass,
bounded memory) when an approximation is acceptable.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import cut_lineage

# A per-group table of at most this many rows is held as local rows and
# broadcast (which keeps few or hot groups from being shuffled); a larger one
# is a table of the cluster and joined by key.
BROADCAST_GROUPS = 100_000
# Cells per power of two in the first round, and per unsettled cell later.
FIRST_CELLS = 1 << 10
CELLS = 1 << 16


RANK = "struct<i:int,upper:boolean,rank:bigint>"
MOMENTS = "n bigint, mean double, std double, least double, most double"
ARROW = {"bigint": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()),
         f"array<{RANK}>": pa.list_(pa.struct([("i", pa.int32()), ("upper", pa.bool_()), ("rank", pa.int64())]))}


def local_rows(table: DataFrame) -> pa.Table | None:
    """The rows of a per-group table if there are few enough to hold, else None."""
    rows = table.limit(BROADCAST_GROUPS + 1).toArrow()
    return rows if rows.num_rows <= BROADCAST_GROUPS else None


def per_group(table: DataFrame) -> DataFrame:
    """A small per-group table, computed once: local rows with a broadcast hint
    if their checked number allows it, else a table cut from its lineage."""
    rows = local_rows(table)
    if rows is None:
        return cut_lineage(table)
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def quoted(name: str) -> str:
    """A column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"named_struct('column', {text_literal(c)}, 'v', double({quoted(c)}))" for c in columns)
    long = df.select(*[F.col(b) for b in by], F.expr(f"inline(array({pairs}))"))
    return long.filter("v IS NOT NULL AND NOT isnan(v)")


def quantile_arrays(
    df: DataFrame,
    columns: Sequence[str],
    ps: Sequence[float],
    by: Sequence[str] = (),
    *,
    accuracy: int | None = None,
    moments: bool = False,
) -> DataFrame:
    """(*by, column, values): an array of the quantiles ``ps`` for every group;
    nulls and NaN ignored; groups with no values are absent. ``moments`` adds n,
    mean, std (of a sample), least and most, from the same pass as the first
    counts."""
    by = list(by)
    long = _long(df, columns, by)
    groups = [*by, "column"]
    if not accuracy:
        return _narrowed(long, groups, [float(p) for p in ps], moments)
    values = F.percentile_approx("v", list(ps), accuracy).alias("values")
    plain = ("count(1) AS n", "avg(v) AS mean", "stddev_samp(v) AS std", "min(v) AS least", "max(v) AS most")
    return long.groupBy(*groups).agg(values, *map(F.expr, plain if moments else ()))


def quantiles_long(
    df: DataFrame,
    columns: Sequence[str],
    ps: Sequence[float],
    by: Sequence[str] = (),
    *,
    accuracy: int | None = None,
) -> DataFrame:
    """(*by, column, p, value) for every group and requested quantile;
    nulls and NaN ignored; groups with no values are absent."""
    values = quantile_arrays(df, columns, ps, by, accuracy=accuracy)
    each = [F.struct(F.lit(float(p)).alias("p"), F.col("values")[i].alias("value")) for i, p in enumerate(ps)]
    return values.select(*by, "column", F.inline(F.array(*each)))


def quantiles_wide(
    df: DataFrame,
    columns: Sequence[str],
    ps: Sequence[float],
    names: Sequence[str],
    by: Sequence[str] = (),
    *,
    accuracy: int | None = None,
) -> DataFrame:
    """(*by, column, <name per p>...) — one row per group and column."""
    values = quantile_arrays(df, columns, ps, by, accuracy=accuracy)
    return values.select(*by, "column", *[F.col("values")[i].alias(n) for i, n in enumerate(names)])


def leading_bits(v: str) -> str:
    """Cell of a double: a whole number that never falls as the value rises, as
    the sign, exponent and first mantissa bits do. Logarithm, product and floor
    never fall either, so values of one cell are neighbours."""
    cell = f"floor(ln(abs({v})) * {FIRST_CELLS / math.log(2)!r}D) + {2048 * FIRST_CELLS}"
    cell = f"if(abs({v}) = double('Infinity'), {4096 * FIRST_CELLS}, {cell})"
    return f"bigint(CASE WHEN {v} > 0 THEN {cell} WHEN {v} < 0 THEN -{cell} ELSE 0 END)"


def _cells(rows: DataFrame, keys: list[str], cell: str, *more: str) -> DataFrame:
    """Count, least and greatest value of each cell of each key."""
    measures = ("count(1) AS k", "min(v) AS least", "max(v) AS most", *more)
    return rows.groupBy(*keys, F.expr(cell).alias("_cell")).agg(*map(F.expr, measures))


def _holding(cells: DataFrame, keys: list[str], before: str, ranks: str) -> DataFrame:
    """The cells that hold one of the ranks, with those ranks and the number of values below the cell."""
    over = ", ".join(map(quoted, keys))
    cells = cells.selectExpr("*", f"{before} + sum(k) OVER (PARTITION BY {over} ORDER BY _cell ROWS UNBOUNDED PRECEDING) - k AS below")
    cells = cells.selectExpr("*", f"filter({ranks}, r -> r.rank >= below AND r.rank < below + k) AS ranks")
    return cells.filter("size(ranks) > 0")


def _holding_rows(cells: list[dict], keys: list[str], ranks: Callable[[dict, int], list[dict]]) -> list[dict]:
    """``_holding`` for cells that are few enough to be local rows; ``start`` is the
    number of values below a key's cells."""
    by_key: dict[str, list[dict]] = {}
    for r in cells:
        by_key.setdefault(repr([r[k] for k in keys]), []).append(r)
    out = []
    for own in by_key.values():
        own.sort(key=itemgetter("_cell"))
        below, n = own[0].get("start", 0), sum(r["k"] for r in own)
        wanted = ranks(own[0], n)
        for r in own:
            if held := [x for x in wanted if below <= x["rank"] < below + r["k"]]:
                out.append({"n": n, **r, "below": below, "ranks": held})
            below += r["k"]
    return out


def _local_moments(cells: list[dict]) -> dict:
    """n, mean, std, least and most of a group from those of its cells."""
    n = sum(c["k"] for c in cells)
    mean = sum(c["k"] * c["mean"] for c in cells) / n
    square = sum(c["k"] * (c["var"] + (c["mean"] - mean) * (c["mean"] - mean)) for c in cells)
    return {"n": n, "mean": mean, "std": math.sqrt(square / (n - 1)) if n > 1 else None,
            "least": min(c["least"] for c in cells), "most": max(c["most"] for c in cells)}


def _moments(cells: DataFrame, groups: list[str]) -> DataFrame:
    """The same for any number of groups."""
    over = f"OVER (PARTITION BY {', '.join(map(quoted, groups))})"
    cells = cells.selectExpr("*", f"sum(k * mean) {over} / sum(k) {over} AS whole")
    return cells.groupBy(*groups).agg(
        F.expr("sum(k) AS n"), F.expr("first(whole) AS mean"),
        F.expr("if(sum(k) > 1, sqrt(sum(k * (var + (mean - whole) * (mean - whole))) / (sum(k) - 1)), NULL) AS std"),
        F.expr("min(least) AS least"), F.expr("max(most) AS most"))


def _narrowed(long: DataFrame, groups: list[str], ps: list[float], moments: bool = False) -> DataFrame:
    """(*groups, values) for the rows (*groups, v), and with ``moments`` n, mean,
    std, least and most: see the module's text.

    A running sum goes over one group's cells: those that hold its values, of
    1,024 to a power of two (later: of 65,536), whatever the number of rows."""
    spark, by = long.sparkSession, ", ".join(map(quoted, groups))
    schema = T.StructType([*[long.schema[g] for g in groups], *T.StructType.fromDDL(
        f"n bigint, below bigint, least double, most double, ranks array<{RANK}>").fields])

    def all_ranks(_: dict, n: int) -> list[dict]:
        return [{"i": i, "upper": upper, "rank": int(end(p * (n - 1)))}
                for i, p in enumerate(ps) for upper, end in ((False, math.floor), (True, math.ceil))]

    more = ("avg(v) AS mean", "var_pop(v) AS var") if moments else ()
    cells = _cells(long, groups, leading_bits("v"), *more)
    rows = local_rows(cells)
    measured: dict[str, dict] | DataFrame = {}
    if rows is not None:
        kinds, rows = [rows.schema.field(g) for g in groups], rows.to_pylist()
        if moments:
            by_group: dict[str, list[dict]] = {}
            for r in rows:
                by_group.setdefault(repr([r[g] for g in groups]), []).append(r)
            measured = {key: {**{g: own[0][g] for g in groups}, **_local_moments(own)} for key, own in by_group.items()}
        found = _holding_rows(rows, groups, all_ranks)
    else:
        measured = _moments(cells, groups) if moments else measured
        places = ", ".join(
            f"named_struct('i', {i}, 'upper', {upper}, 'rank', bigint({rank}({p!r}D * (n - 1))))"
            for i, p in enumerate(ps) for upper, rank in (("false", "floor"), ("true", "ceil")))
        cells = cells.selectExpr("*", f"sum(k) OVER (PARTITION BY {by}) AS n")
        found = _holding(cells, groups, "0", f"array({places})").select(*schema.names)
        rows = local_rows(found)
        kinds = [] if rows is None else [rows.schema.field(g) for g in groups]
        found = found if rows is None else rows.to_pylist()
    local, tables = [], []  # settled cells: local rows, and tables of the cluster
    while True:
        if isinstance(found, DataFrame):
            found = cut_lineage(found)
            tables.append(found.filter("least = most"))
            left = found.filter("least < most")
            if left.isEmpty():
                break
        else:
            local += [r for r in found if r["least"] == r["most"]]
            left = [r for r in found if r["least"] < r["most"]]
            if not left:
                break
            left = F.broadcast(_local_table(spark, left, schema, kinds))
        # each cell becomes a key of its own: a value lies in one cell of its group at most
        left = left.withColumnsRenamed({g: f"_g_{g}" for g in groups})
        same = " AND ".join(f"{quoted(g)} <=> {quoted('_g_' + g)}" for g in groups)
        near = long.join(left, F.expr(f"{same} AND v BETWEEN least AND most"))
        near = near.selectExpr(*map(quoted, groups), "n", "below AS start", "least AS lowest", "ranks AS wanted", "v",
                               f"(most - least) / {CELLS} AS width")
        keys = [*groups, "lowest"]
        cut = _cells(near, [*keys, "n", "start"], "if(width > 0, floor((v - lowest) / width), bigint(v > lowest))",
                     "first(wanted) AS wanted")
        rows = local_rows(cut) if not isinstance(found, DataFrame) else None
        if rows is not None:
            found = _holding_rows(rows.to_pylist(), keys, lambda r, n: r["wanted"])
        else:
            held = _holding(cut, keys, "start", "wanted").select(*schema.names)
            rows = local_rows(held) if not isinstance(found, DataFrame) else None
            found = held if rows is None else rows.to_pylist()
    if not tables:
        out = _local_values(spark, local, schema, kinds, groups, ps)
        return _joined(out, measured, schema, kinds, groups) if moments else out
    if local:
        tables.append(_local_table(spark, local, schema, kinds))
    each = reduce(DataFrame.unionByName, tables).selectExpr(*map(quoted, groups), "n", "least AS v", "inline(ranks)")
    ends = each.groupBy(*groups).agg(F.first("n").alias("n"), *[
        F.expr(f"max(v) FILTER (WHERE i = {i} AND upper = {upper}) AS _{i}_{upper}")
        for i in range(len(ps)) for upper in ("false", "true")])
    values = ", ".join(f"if(_{i}_false = _{i}_true, _{i}_false, _{i}_false + (_{i}_true - _{i}_false)"
                       f" * ({p!r}D * (n - 1) - floor({p!r}D * (n - 1))))" for i, p in enumerate(ps))
    ends = ends.select(*groups, F.expr(f"array({values})").alias("values"))
    return _joined(ends, measured, schema, kinds, groups) if moments else ends


def _joined(
    values: DataFrame, measured: DataFrame | dict[str, dict], schema: T.StructType, kinds: list[pa.Field], groups: list[str]
) -> DataFrame:
    """``values`` with the moments of the groups, be they local rows or a table."""
    if isinstance(measured, dict):
        fields = [*schema.fields[: len(groups)], *T.StructType.fromDDL(MOMENTS).fields]
        measured = F.broadcast(_local_table(values.sparkSession, list(measured.values()), T.StructType(fields), kinds))
    own = measured.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    same = " AND ".join(f"{quoted(g)} <=> {quoted('_g_' + g)}" for g in groups)
    return values.join(own, F.expr(same)).drop(*[f"_g_{g}" for g in groups])


def _local_table(spark: SparkSession, rows: list[dict], schema: T.StructType, kinds: list[pa.Field]) -> DataFrame:
    """Rows as a local relation; ``kinds`` are Arrow's types of the first columns."""
    rest = [pa.field(f.name, ARROW[f.dataType.simpleString()]) for f in schema.fields[len(kinds):]]
    return spark.createDataFrame(pa.Table.from_pylist(rows, pa.schema([*kinds, *rest])), schema)


def _local_values(
    spark: SparkSession, settled: list[dict], schema: T.StructType, kinds: list[pa.Field], groups: list[str], ps: list[float]
) -> DataFrame:
    """(*groups, values) from the settled cells, few enough to be local rows."""
    ends: dict[str, dict] = {}
    for r in settled:
        own = ends.setdefault(repr([r[g] for g in groups]), {"row": r})
        own.update({(x["i"], x["upper"]): r["least"] for x in r["ranks"]})
    out = []
    for own in ends.values():
        values = []
        for i, p in enumerate(ps):
            lo, hi, pos = own[i, False], own[i, True], p * (own["row"]["n"] - 1)
            values.append(lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos)))
        out.append({**own["row"], "values": values})
    fields = [*schema.fields[: len(groups)], T.StructField("values", T.ArrayType(T.DoubleType()))]
    return _local_table(spark, out, T.StructType(fields), kinds)


def medians_by_column(df: DataFrame, columns: Sequence[str], *, accuracy: int | None = None) -> dict:
    """Median of each column (columns without values are absent), all
    narrowed together; one small row per column reaches the driver."""
    q = quantiles_long(df, columns, [0.5], accuracy=accuracy)
    return {r.column: r.value for r in q.collect()}
