"""Student-t tail probabilities in a constant number of steps (REG2).

With a = df / 2, x = df / (df + t^2) and y = 1 - x, the one-sided tail is

    P(T > |t|) = I_x(a, 1/2) / 2 = (1 - I_y(1/2, a)) / 2

for any real df > 0.  The regularised incomplete beta function I is evaluated
by its continued fraction, from the second form where t^2 < 3 and from the
first beyond, so small tails keep their digits.  ``STEPS`` terms bring either
to the rounding of a double for every df: nothing grows with df.  The gamma
quotient in front comes from its asymptotic series about df / 2 - 1/4.
Beyond 10^9 degrees of freedom the tail no longer changes in nine digits, and
df counts as 10^9.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 140
_SHIFT = 32                                  # the series is used from here on; smaller arguments are raised by as much
_MOST_DF, _MOST_T = 1e9, 1e150


def _series(z):
    """Gamma(z + 1/2) / Gamma(z) over the square root of z - 1/4, for large z."""
    v = 1 / ((z - 0.25) * (z - 0.25))
    return 1 / (1 - v * (1 / 64 - v * (21 / 8192 - v * (671 / 524288 - v * (180323 / 134217728)))))


def _raised(z):
    """The quotient at z over that at z + ``_SHIFT``."""
    out = 1.0
    for i in range(_SHIFT):
        out = out * ((z + i) / (z + i + 0.5))
    return out


def _even(m, x, a, b):
    """Numerator number 2 m of the continued fraction of I_x(a, b)."""
    return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))


def _odd(m, x, a, b):
    """Numerator number 2 m + 1."""
    return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))


def t_sf(t, dof) -> Column:
    """One-sided p-value ``P(T > |t|)``; NULL when t or df is NULL or NaN, or df <= 0."""
    given = F.abs(F.col(t) if isinstance(t, str) else t).cast("double")
    given_df = (F.col(dof) if isinstance(dof, str) else dof).cast("double")
    df, tc = F.least(given_df, F.lit(_MOST_DF)), F.least(given, F.lit(_MOST_T))
    ok = given.isNotNull() & ~F.isnan(given) & (given_df > 0) & ~F.isnan(given_df)
    # one struct, so that the fraction's steps read finished values
    z = df / 2
    gamma = F.when(z < _SHIFT, _raised(z) * F.sqrt(z + _SHIFT - 0.25) * _series(z + _SHIFT)) \
        .otherwise(F.sqrt(z - 0.25) * _series(z))
    y = tc * tc / (df + tc * tc)
    front = F.sqrt(y) * F.exp(-z * F.log1p(tc * tc / df)) * gamma / math.sqrt(math.pi)
    near = tc * tc < 3
    start = F.struct(F.when(near, y).otherwise(df / (df + tc * tc)).alias("x"), F.when(near, 0.5).otherwise(z).alias("a"),
                     F.when(near, z).otherwise(0.5).alias("b"), near.alias("near"),
                     F.when(near, front).otherwise(front / z / 2).alias("front"), F.lit(1.0).alias("r"))

    def step(s, k):
        m = F.floor(k / 2).cast("double")
        at = m, s["x"], s["a"], s["b"]
        d = F.when(k % 2 == 0, _even(*at)).otherwise(_odd(*at))
        return F.struct(s["x"].alias("x"), s["a"].alias("a"), s["b"].alias("b"), s["near"].alias("near"),
                        s["front"].alias("front"), (1 + F.try_divide(d, s["r"])).alias("r"))

    steps = F.sequence(F.lit(STEPS), F.lit(1), F.lit(-1))
    p = F.aggregate(steps, start, step, lambda s: F.when(s["near"], 0.5 - F.try_divide(s["front"], s["r"]))
                    .otherwise(F.try_divide(s["front"], s["r"])))
    return F.when(ok, F.greatest(p, F.lit(0.0)))


def t_two_sided(t, dof) -> Column:
    """Two-sided p-value ``P(|T| > |t|)``."""
    return F.least(2 * t_sf(t, dof), F.lit(1.0))


def t_sf_value(t: float | None, dof: float) -> float | None:
    """:func:`t_sf` for one number, for statistics solved on the driver."""
    if t is None or math.isnan(t) or not dof > 0:
        return None
    df, t = min(float(dof), _MOST_DF), min(abs(t), _MOST_T)
    z, near = df / 2, t * t < 3
    gamma = _raised(z) * math.sqrt(z + _SHIFT - 0.25) * _series(z + _SHIFT) if z < _SHIFT else math.sqrt(z - 0.25) * _series(z)
    y = t * t / (df + t * t)
    front = math.sqrt(y) * math.exp(-z * math.log1p(t * t / df)) * gamma / math.sqrt(math.pi)
    x, a, b = (y, 0.5, z) if near else (df / (df + t * t), z, 0.5)
    r = 1.0
    for k in range(STEPS, 0, -1):
        r = 1 + (_odd if k % 2 else _even)(float(k // 2), x, a, b) / r
    return max(0.5 - front / r if near else front / z / 2 / r, 0.0)
