"""Numeric helpers (F14-F16) and engine-independent means.

``mean`` computes the average as an exact sum (decimals add exactly) divided
once in double precision; ``round_half_up`` is the IEEE form of ROUND half away
from zero.  Both give bit-identical results on any engine that follows IEEE
754, which keeps report values stable across engines and reruns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mean(x) -> Column:
    """AVG as exact SUM / COUNT in double; NULL when no non-null input."""
    x = _c(x)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def round_half_up(x, n: int = 0) -> Column:
    """ROUND half away from zero on a double: sign * floor(|x| * 10^n + 0.5) / 10^n."""
    x = _c(x).cast("double")
    p = float(10 ** n)
    mag = F.floor(F.abs(x) * p + 0.5).cast("double") / p
    return F.when(x < 0, -mag).otherwise(mag)


def round_half_even(x, n: int = 0) -> Column:
    """Half-to-even as a pandas/numpy ``.round(n)`` does it: rint(x * 10^n) / 10^n."""
    p = float(10 ** n)
    return F.rint(_c(x).cast("double") * p) / p


def to_double(df):
    """Cast every decimal column to double (dashboard clients do this)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def clean_floor(x, floor: float = 1.0) -> Column:
    """F16: numeric coerce, NULL -> 0, then floor at ``floor`` (marker size)."""
    v = F.coalesce(_c(x).try_cast("double"), F.lit(0.0))
    return F.greatest(v, F.lit(float(floor)))
