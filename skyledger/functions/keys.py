"""Surrogate keys (F8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: placeholder the surrogate-key convention substitutes for NULL parts.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols) -> Column:
    """MD5 hex of the '-'-joined string casts, NULL parts replaced by a placeholder."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_PLACEHOLDER))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def instant_text(c) -> Column:
    """An instant as key text: ``YYYY-MM-DD HH:MM:SS+00`` (the session's zone is UTC)."""
    return F.concat((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("+00"))
