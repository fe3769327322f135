"""Match keys for overlap detection.

Accent stripping is Unicode NFKD decomposition with combining marks
removed. Spark has no NFKD function, so this is the library's one
Arrow-batched pandas UDF. Only texts that contain a non-ASCII character
are handed to it; ASCII rows pass a NULL (nearly free to ship) and keep
their text JVM-side.
"""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.exprs import ColumnOrName, _col

# Ship this module's functions to Python workers by value: executors need
# not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _strip_one(value):
    if value is None or value.isascii():
        return value
    decomposed = unicodedata.normalize("NFKD", value)
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def _strip_accents_batch(values: pd.Series) -> pd.Series:
    return values.map(_strip_one, na_action="ignore")


# Marked non-deterministic only so that Catalyst never duplicates it: a
# filter on a key column would otherwise be pushed below the projection and
# re-run the whole key expression (UDF and regexes over full texts) twice.
_strip_accents_udf = F.pandas_udf(_strip_accents_batch, StringType()).asNondeterministic()


def strip_accents(c: ColumnOrName) -> Column:
    """NFKD decomposition with combining marks removed."""
    text = _col(c).cast("string")
    non_ascii = text.rlike("[^\\x00-\\x7F]")
    return F.coalesce(_strip_accents_udf(F.when(non_ascii, text)), text)


def name_key(c: ColumnOrName) -> Column:
    """Punctuation/case/accent-insensitive text key.

    Defined as whitespace-normalize -> strip accents -> lower -> runs of
    characters outside ``[a-z0-9]`` become one space -> whitespace-normalize.
    Whitespace is itself outside ``[a-z0-9]`` before and after NFKD, so the
    two whitespace passes reduce to a final trim of single spaces.
    Null/blank -> ``''``. Materialize keys with ``select``/``withColumn``
    before aggregating them (the UDF inside is non-deterministic to Spark).
    """
    keyed = F.regexp_replace(F.lower(strip_accents(F.coalesce(_col(c).cast("string"), F.lit("")))), "[^a-z0-9]+", " ")
    return F.trim(keyed)


def code_key(c: ColumnOrName) -> Column:
    """Code key: whitespace-normalize -> strip accents -> upper -> keep only
    ``[A-Z0-9]``. Null/blank -> ``''``."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    return F.regexp_replace(F.upper(strip_accents(text)), "[^A-Z0-9]", "")
