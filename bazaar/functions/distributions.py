"""Scalar distribution functions for test statistics (driver side, applied to
a handful of numbers such as k coefficients).  scipy is not available, so the
regularized incomplete beta is evaluated by its continued fraction, whose length
doesn't grow with the degrees of freedom of a t or F test."""

from __future__ import annotations

import math
from statistics import NormalDist

_N = NormalDist()


def norm_cdf(x: float) -> float:
    return _N.cdf(x)


def norm_ppf(p: float) -> float:
    return _N.inv_cdf(p)


def _stirling_rest(a: float) -> float:
    """lgamma(a) - ((a - 1/2) ln a - a + ln(2 pi) / 2), for a >= 10."""
    s = 1.0 / (a * a)
    return (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / a


def log_beta(a: float, b: float) -> float:
    """ln B(a, b), without the cancellation of large lgamma values."""
    a, b = max(a, b), min(a, b)
    if a < 10:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    # lgamma(a) - lgamma(a + b) from Stirling's formula, logarithms combined
    part = b - (a - 0.5) * math.log1p(b / a) - b * math.log(a + b) + _stirling_rest(a) - _stirling_rest(a + b)
    return math.lgamma(b) + part


def _beta_fraction(a: float, b: float, x: float, y: float) -> float:
    """I_x(a, b) * a * B(a, b) / (x^a y^b) for y = 1 - x: the even part of the usual
    continued fraction, by Lentz's method.  Denominators are written in y, so they
    keep their digits where x is next to 1 (many degrees of freedom)."""
    odd = lambda m: -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
    c = h = (a * (1 - b) + a * (a + b) * y) / (a * (a + 1))
    c = h = h if h else 1e-300
    d, m = 0.0, 0
    while True:
        m += 1
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        # 1 + odd(m) without cancellation
        rest = (a * (2 * m + 1 - b) + m * (3 * m + 2 - b) + (a + m) * (a + b + m) * y) / ((a + 2 * m) * (a + 2 * m + 1))
        numerator, denominator = -odd(m - 1) * even, rest + even
        d = 1.0 / (denominator + numerator * d or 1e-300)
        c = denominator + numerator / c or 1e-300
        h *= c * d
        if abs(c * d - 1.0) < 1e-16 or m >= 100_000:
            return 1.0 / h


def _beta_tails(a: float, b: float, x: float, y: float) -> tuple[float, float]:
    """(I_x(a, b), 1 - I_x(a, b)) for x + y = 1, both given so that neither is lost
    next to 1."""
    if x <= 0.0:
        return 0.0, 1.0
    if y <= 0.0:
        return 1.0, 0.0
    log_x = math.log(x) if x < y else math.log1p(-y)
    log_y = math.log(y) if y < x else math.log1p(-x)
    front = math.exp(a * log_x + b * log_y - log_beta(a, b))
    if x * (a + b + 2.0) <= a + 1.0:
        low = front * _beta_fraction(a, b, x, y) / a
        return low, 1.0 - low
    high = front * _beta_fraction(b, a, y, x) / b
    return 1.0 - high, high


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    return _beta_tails(a, b, x, 1.0 - x)[0]


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    if math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    whole = df + t * t
    return _beta_tails(df / 2.0, 0.5, df / whole, t * t / whole)[0]


def t_cdf(t: float, df: float) -> float:
    p = 0.5 * t_sf2(t, df)
    return 1.0 - p if t > 0 else p


def t_ppf(q: float, df: float) -> float:
    """Inverse CDF of Student's t: Newton steps on the upper tail from the normal
    quantile.  It lies below the t quantile and the CDF is concave there, so the
    steps approach the quantile from below."""
    if q < 0.5:
        return -t_ppf(1.0 - q, df)
    if q == 0.5 or q >= 1.0:
        return 0.0 if q == 0.5 else math.inf
    tail, t = 1.0 - q, norm_ppf(q)
    log_scale = -0.5 * math.log(df) - log_beta(df / 2.0, 0.5)
    for _ in range(200):
        density = math.exp(log_scale - (df + 1.0) / 2.0 * math.log1p(t * t / df))
        step = (0.5 * t_sf2(t, df) - tail) / density
        t += step
        if abs(step) <= 1e-14 * max(abs(t), 1e-3):
            break
    return t


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    whole = d2 + d1 * f
    return _beta_tails(d2 / 2.0, d1 / 2.0, d2 / whole, d1 * f / whole)[0]
