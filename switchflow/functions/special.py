"""Distribution functions as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos' series for the gamma function with g = 7.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 0.5."""
    z = x - 1
    series = sum((F.lit(c) / (z + i) for i, c in enumerate(LANCZOS[1:], 1)), F.lit(LANCZOS[0]))
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(series)


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's rule; converges for x < (a + 1) / (a + b + 2)."""
    steps = (F.lit(60) + 4 * F.sqrt(F.greatest(a, b))).cast("int")
    safe = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)
    d0 = 1 / safe(1 - (a + b) * x / (a + 1))

    def half(s: Column, term: Column) -> Column:
        d, c = 1 / safe(1 + term * s["d"]), safe(1 + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # The first half is bound to a name, as the second one uses it three times.
        return F.transform(F.array(half(s, even)), lambda e: half(e, odd))[0]

    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["h"])


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularized incomplete beta function I_x(a, b) for 0 <= x <= 1 and a, b >= 0.5."""
    x, a, b = x.cast("double"), a.cast("double"), b.cast("double")
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    small = front * _fraction(x, a, b) / a
    large = 1 - front * _fraction(1 - x, b, a) / b
    inside = F.when(x < (a + 1) / (a + b + 2), small).otherwise(large)
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), inside)))


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t; null without degrees of freedom."""
    df = df.cast("double")
    return F.when(df > 0, incomplete_beta(df / (df + t * t), df / 2, F.lit(0.5)))


def f_p_value(f: Column, df1: Column, df2: Column) -> Column:
    """Probability of a greater F; null without degrees of freedom."""
    df1, df2 = df1.cast("double"), df2.cast("double")
    return F.when((df1 > 0) & (df2 > 0) & f.isNotNull(), incomplete_beta(df2 / (df2 + df1 * F.greatest(f, F.lit(0.0))), df2 / 2, df1 / 2))
