"""Column expressions (no jobs, no shuffles)."""

from strata.functions.exprs import *  # noqa: F401,F403
from strata.functions.text import code_key, name_key, strip_accents  # noqa: F401
