"""Tail probabilities of the normal, t, F and chi-square laws, and the unit-root
response surface. Scalar helpers: they run on a handful of statistics per group,
never on data rows."""

from __future__ import annotations

import math


def normal_sf2(z: float) -> float:
    """Two-sided tail of the standard normal."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def beta_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_reg(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, value, c, d = 1e-300, 1.0, 1.0, 0.0
    for step in range(400):
        m = step // 2
        if step == 0:
            num = 1.0
        elif step % 2 == 0:
            num = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / (1.0 + num * d or tiny)
        c = 1.0 + num / c or tiny
        value *= c * d
        if step and abs(1.0 - c * d) < 1e-15:
            break
    return front * (value - 1.0)


def gamma_sf(a: float, x: float) -> float:
    """Upper regularised incomplete gamma."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - total * scale
    b, c = x + 1.0 - a, 1e300
    d = 1.0 / b
    h = d
    for i in range(1, 500):
        k = -i * (i - a)
        b += 2.0
        d = 1.0 / (k * d + b)
        c = b + k / c
        h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h * scale


def t_sf2(t: float, df: float) -> float:
    return beta_reg(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, df: float) -> float:
    return gamma_sf(df / 2.0, x / 2.0)


def pearson_p(rho: float, n: int) -> float:
    if n < 3 or abs(rho) >= 1.0:
        return 0.0 if n >= 3 else 1.0
    return t_sf2(rho * math.sqrt((n - 2) / (1.0 - rho * rho)), n - 2)


# MacKinnon (1994) response surface for one series with a constant.
ADF_MIN, ADF_MAX, ADF_STAR = -18.83, 2.74, -1.61
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p(stat: float) -> float:
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    coef = ADF_SMALL if stat <= ADF_STAR else ADF_LARGE
    z = sum(c * stat ** i for i, c in enumerate(coef))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))
