"""Pure Column expressions: everything here compiles to JVM expressions and
stays inside whole-stage codegen. No function here triggers a Spark job.

Python's ``str.strip()`` / ``str.split()`` / ``re`` ``\\s`` treat all Unicode
whitespace as blanks, while Spark's ``trim`` strips spaces only. The helpers
below use ``WS``, a Java character class equal to Python's whitespace set
(Java's ``(?U)\\s`` alone misses U+001C..U+001F).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Labels, maps and thresholds that define the operators'
# results. They are data, kept together here in their natural order.
# ---------------------------------------------------------------------------
RARE_TITLES = (
    "Capt", "Col", "Don", "Dona", "Dr", "Jonkheer", "Lady", "Major", "Rev",
    "Sir", "the Countess",
)
TITLE_ALIASES = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
FAMILY_SIZE_EDGES = (0, 1, 4, 6, math.inf)
FAMILY_SIZE_LABELS = ("Alone", "Small", "Medium", "Large")
NOTEBOOK_FAMILY_EDGES = (0, 1, 4, math.inf)
NOTEBOOK_FAMILY_LABELS = ("Alone", "Small", "Large")
AGE_GROUP_EDGES = (0, 12, 18, 35, 60, math.inf)
AGE_GROUP_LABELS = ("Child", "Teen", "Young Adult", "Adult", "Senior")
CONFIDENCE_BAND_EDGES = (0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
HIGH_CONFIDENCE = 0.80
LOW_CONFIDENCE_THRESHOLD = 0.60
CONFIDENCE_LABELS = (
    "High model confidence", "Moderate model confidence", "Low model confidence",
)
CLASS_DISPLAY_NAMES = {1: "First class", 2: "Second class", 3: "Third class"}
SURVIVAL_CODES = {"no": 0, "yes": 1}
PORT_NAME_CODES = {
    "belfast": "B", "cherbourg": "C", "queenstown": "Q", "southampton": "S",
}
PORT_CODE_LETTERS = ("B", "C", "Q", "S")
EXTERNAL_CLASS_CODES = {"1st": 1, "2nd": 2, "3rd": 3}


# Python's whitespace (str.isspace / str.split / re \s) is Java's Unicode
# White_Space property plus U+001C..U+001F; tests check the equivalence.
WS = r"(?U)[\s\x{1C}-\x{1F}]"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Unicode-aware whitespace helpers
# ---------------------------------------------------------------------------

def ustrip(c: ColumnOrName) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip``)."""
    return F.regexp_replace(_col(c), f"^{WS}+|{WS}+$", "")


NON_WS = r"(?U)[^\s\x{1C}-\x{1F}]"


def is_blank(c: ColumnOrName) -> Column:
    """True when null or only whitespace (Python ``not s.strip()``); the
    search stops at the first non-whitespace character."""
    c = _col(c)
    return c.isNull() | ~c.rlike(NON_WS)


def sql_blank(c: ColumnOrName) -> Column:
    """SQL flavour: ``c IS NULL OR TRIM(c) = ''`` (TRIM removes spaces only)."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def normalize_whitespace(c: ColumnOrName) -> Column:
    """Collapse whitespace runs to one space and strip; null -> ``''``."""
    collapsed = F.regexp_replace(F.coalesce(_col(c).cast("string"), F.lit("")), f"{WS}+", " ")
    return F.trim(collapsed)


def blank_to_null(c: ColumnOrName) -> Column:
    """Whitespace-normalized text, with empty results turned into null."""
    return F.nullif(normalize_whitespace(c), F.lit(""))


def lower_trim(c: ColumnOrName) -> Column:
    return F.lower(ustrip(_col(c).cast("string")))


# ---------------------------------------------------------------------------
# Numeric helpers
# ---------------------------------------------------------------------------

def to_double(c: ColumnOrName) -> Column:
    """Lenient numeric coercion: unparsable -> null (``to_numeric(coerce)``)."""
    return _col(c).try_cast("double")


def pct(numerator: ColumnOrName, denominator: ColumnOrName, decimals: int = 2) -> Column:
    """``ROUND(100 * num / den, d)`` in double precision; null when the
    denominator is 0 (empty input) instead of an ANSI division error."""
    return F.round(F.try_divide(F.lit(100.0) * _col(numerator).cast("double"), _col(denominator)), decimals)


def rate_pct(flag: ColumnOrName, decimals: int = 2) -> Column:
    """Aggregate: percentage of a 0/1 flag, ``ROUND(100 * AVG(flag), d)``."""
    return F.round(F.lit(100.0) * F.avg(_col(flag).cast("double")), decimals)


def rounded_avg(c: ColumnOrName, decimals: int = 2) -> Column:
    return F.round(F.avg(_col(c)), decimals)


def count_when(cond: Column) -> Column:
    """Aggregate: ``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` (0 on empty)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def clip_lower(c: ColumnOrName, lower: float = 0.0) -> Column:
    """Clip at a lower bound; null stays null (``greatest`` skips nulls)."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lower)))


def log1p(c: ColumnOrName) -> Column:
    return F.log1p(_col(c))


def clipped_log1p(c: ColumnOrName) -> Column:
    return F.log1p(clip_lower(c, 0.0))


# ---------------------------------------------------------------------------
# Binning, recoding, labelling
# ---------------------------------------------------------------------------

def bin_column(
    c: ColumnOrName,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    *,
    right: bool = True,
    include_lowest: bool = False,
) -> Column:
    """Interval labels for ``edges`` (``pd.cut`` semantics).

    ``right=True`` gives ``(a, b]`` intervals; ``include_lowest`` closes the
    first one on the left. Values outside every interval and nulls -> null.
    Default labels are the interval text ``(a, b]`` as pandas prints it.
    """
    c = _col(c)
    if labels is None:
        labels = [_interval_label(edges[i], edges[i + 1], right, include_lowest and i == 0)
                  for i in range(len(edges) - 1)]
    if len(labels) != len(edges) - 1:
        raise ValueError("labels must have len(edges) - 1 entries")
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        if right:
            low_ok = (c >= F.lit(lo)) if (include_lowest and i == 0) else (c > F.lit(lo))
            high_ok = c <= F.lit(hi)
        else:  # [a, b): already left-closed, include_lowest has no effect (as in pd.cut)
            low_ok = c >= F.lit(lo)
            high_ok = c < F.lit(hi)
        cond = low_ok & high_ok
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def _fmt_edge(x: float) -> str:
    if math.isinf(x):
        return "inf"
    text = f"{x:.3f}".rstrip("0")
    return text + "0" if text.endswith(".") else text


def _interval_label(lo: float, hi: float, right: bool, lowest: bool) -> str:
    left = "(" if right else "["
    if right and lowest:
        lo_text = _fmt_edge(lo - 0.001)
    else:
        lo_text = _fmt_edge(lo)
    return f"{left}{lo_text}, {_fmt_edge(hi)}{']' if right else ')'}"


def recode(c: ColumnOrName, mapping: Mapping[Any, Any]) -> Column:
    """Dictionary recode; unmapped values (and null) -> null."""
    if not mapping:
        return F.lit(None)
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return lookup[_col(c)]


def coalesce_default(c: ColumnOrName, default: Any) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def list_position(c: ColumnOrName, order: Sequence[Any]) -> Column:
    """1-based position of the value in ``order``; unknown/null -> len+1.

    Used to sort by a fixed category order (``ORDER BY CASE ... END``).
    """
    c = _col(c)
    expr = None
    for i, value in enumerate(order, start=1):
        expr = F.when(c == F.lit(value), F.lit(i)) if expr is None else expr.when(c == F.lit(value), F.lit(i))
    return expr.otherwise(F.lit(len(order) + 1))


def confidence_band(confidence: ColumnOrName) -> Column:
    """High / moderate / low model-confidence label for a probability."""
    c = _col(confidence)
    return (F.when(c >= HIGH_CONFIDENCE, F.lit(CONFIDENCE_LABELS[0]))
            .when(c >= LOW_CONFIDENCE_THRESHOLD, F.lit(CONFIDENCE_LABELS[1]))
            .otherwise(F.lit(CONFIDENCE_LABELS[2])))


def class_display_name(c: ColumnOrName, names: Mapping[int, str] = CLASS_DISPLAY_NAMES) -> Column:
    """Readable class name; unknown value -> ``Class <value>``."""
    c = _col(c)
    mapped = recode(c.cast("string"), {str(k): v for k, v in names.items()})
    return F.coalesce(mapped, F.concat(F.lit("Class "), c.cast("string")))


# ---------------------------------------------------------------------------
# Passenger-style feature extraction (generic text operators)
# ---------------------------------------------------------------------------

TITLE_PATTERN = f",{WS}*([^.]*)\\."


def extract_title(
    name: ColumnOrName,
    aliases: Mapping[str, str] = TITLE_ALIASES,
    rare: Sequence[str] = RARE_TITLES,
    unknown: str = "Unknown",
) -> Column:
    """Honorific between the first comma and the next period.

    Blank/null/no match -> ``unknown``; aliases applied; rare titles ->
    ``Rare``. A match with an empty title yields ``''`` as in the original.
    """
    n = _col(name)
    raw = ustrip(F.regexp_extract(n, TITLE_PATTERN, 1))
    aliased = F.coalesce(recode(raw, aliases), raw) if aliases else raw
    title = F.when(aliased.isin(list(rare)), F.lit("Rare")).otherwise(aliased) if rare else aliased
    return (F.when(is_blank(n), F.lit(unknown))
            .when(~n.rlike(TITLE_PATTERN), F.lit(unknown))
            .otherwise(title))


def extract_surname(name: ColumnOrName, unknown: str = "Unknown") -> Column:
    """Text before the first comma, stripped; empty -> ``unknown``."""
    n = _col(name)
    head = ustrip(F.substring_index(n, ",", 1))
    return F.when(is_blank(n) | (head == ""), F.lit(unknown)).otherwise(head)


def first_letter(c: ColumnOrName, unknown: str = "Unknown") -> Column:
    """Upper-cased first character when alphabetic, else ``unknown``."""
    c = _col(c)
    # first non-whitespace character, found without stripping the whole text
    first = F.upper(F.regexp_extract(c, f"^{WS}*({NON_WS})", 1))
    return F.when(is_blank(c), F.lit(unknown)).when(first.rlike(r"^\p{L}+$"), first).otherwise(F.lit(unknown))


def token_count(c: ColumnOrName) -> Column:
    """Number of whitespace-separated tokens; blank/null -> 0."""
    c = _col(c)
    return F.when(is_blank(c), F.lit(0)).otherwise(F.size(F.split(ustrip(c), f"{WS}+"))).cast("long")


def token_prefix(c: ColumnOrName, unknown: str = "Unknown", none: str = "NONE") -> Column:
    """Ticket-style prefix: upper, drop ``.``, ``/`` -> space, drop the last
    token, join the rest with ``_``; a single token -> ``none``."""
    c = _col(c)
    cleaned = ustrip(F.regexp_replace(F.regexp_replace(F.upper(c), r"\.", ""), "/", " "))
    parts = F.split(cleaned, f"{WS}+")
    n = F.size(parts)
    return (F.when(is_blank(c), F.lit(unknown))
            .when((cleaned == "") | (n <= 1), F.lit(none))
            .otherwise(F.array_join(F.slice(parts, 1, n - 1), "_")))


def letters_prefix(c: ColumnOrName, none: str = "NONE") -> Column:
    """Notebook variant: drop ``.`` and ``/``, first run of ASCII letters."""
    c = _col(c)
    cleaned = F.regexp_replace(c.cast("string"), r"[./]", "")
    found = F.regexp_extract(cleaned, r"([A-Za-z]+)", 1)
    return F.when(c.isNull() | (found == ""), F.lit(none)).otherwise(found)


def notebook_title(name: ColumnOrName) -> Column:
    """Notebook variant of the title: raw capture, no recoding; null if none."""
    pattern = r",\s*([^\.]+)\."
    n = _col(name)
    return F.when(n.rlike(pattern), F.regexp_extract(n, pattern, 1))


def notebook_deck(cabin: ColumnOrName, filler: str = "Unknown") -> Column:
    """Notebook variant of the deck: first char of the filled text."""
    return F.substring(F.coalesce(_col(cabin), F.lit(filler)), 1, 1)


def family_size(*counts: ColumnOrName) -> Column:
    """Sum of counts (null/unparsable -> 0) plus one, as a long."""
    total = F.lit(1.0)
    for c in counts:
        total = total + F.coalesce(to_double(c), F.lit(0.0))
    return total.cast("long")


def equals_flag(c: ColumnOrName, value: Any = 1) -> Column:
    return (_col(c) == F.lit(value)).cast("int")


def presence_flag(c: ColumnOrName) -> Column:
    """1 when not null (a blank string counts as present)."""
    return _col(c).isNotNull().cast("int")


def ids_json(ids: ColumnOrName) -> Column:
    """Array of ids -> ``[1, 2]`` text (JSON with Python's spacing)."""
    arr = _col(ids)
    return F.concat(F.lit("["), F.coalesce(F.array_join(arr, ", "), F.lit("")), F.lit("]"))


# ---------------------------------------------------------------------------
# External-source harmonization helpers
# ---------------------------------------------------------------------------

def yes_no_code(c: ColumnOrName, codes: Mapping[str, int] = SURVIVAL_CODES) -> Column:
    """``yes``/``no`` (any case, padded) -> 1/0; null stays null; any other
    value fails the job with the offending value in the message."""
    v = lower_trim(c)
    expr = F.when(v.isNull(), F.lit(None).cast("long"))
    for text, code in codes.items():
        expr = expr.when(v == F.lit(text), F.lit(code).cast("long"))
    return expr.otherwise(F.raise_error(F.concat(F.lit("Unexpected yes/no value: "), v)).cast("long"))


def port_code(
    c: ColumnOrName,
    names: Mapping[str, str] = PORT_NAME_CODES,
    letters: Sequence[str] = PORT_CODE_LETTERS,
) -> Column:
    """Embarkation port code: known name -> code; first letter if it is a
    known code; otherwise the upper-cased text; blank/null -> null."""
    text = normalize_whitespace(c)
    first = F.upper(F.substring(text, 1, 1))
    return (F.when(_col(c).isNull() | (text == ""), F.lit(None).cast("string"))
            .when(F.lower(text).isin(list(names)), recode(F.lower(text), names))
            .when(first.isin(list(letters)), first)
            .otherwise(F.upper(text)))
