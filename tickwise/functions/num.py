"""Column helpers shared by every model: rounding, guarded division, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text the surrogate-key macro substitutes for a NULL part.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x, places: int) -> Column:
    """Round half away from zero on a decimal, then back to double.

    Rounding a double directly differs between engines at ties
    (0.285 -> 0.29 or 0.28); going through DECIMAL(38,12) makes the
    result identical to the SQL ``numeric`` rounding the models use.
    """
    return F.round(_c(x).cast("decimal(38,12)"), places).cast("double")


def safe_div(num, den) -> Column:
    """num / nullif(den, 0): NULL instead of a divide-by-zero error."""
    d = _c(den)
    return _c(num) / F.when(d != 0, d)


def surrogate_key(*cols) -> Column:
    """md5 over the '-'-joined text of each part, NULL parts as a token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
