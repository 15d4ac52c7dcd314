"""Scalar statistics: bias-corrected moments as Column expressions, and the
distribution functions needed for p-values (SciPy is not available).

The p-value functions take a handful of driver-side scalars that come out of
one aggregate; they never see rows."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(g1: Column, n: Column) -> Column:
    """Adjusted Fisher-Pearson skewness G1 from Spark's population ``skewness``."""
    nd = n.cast("double")
    return F.when(nd > 2, g1 * F.sqrt(nd * (nd - 1)) / (nd - 2))


def sample_excess_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from Spark's population ``kurtosis``."""
    nd = n.cast("double")
    return F.when(nd > 3, (nd - 1) / ((nd - 2) * (nd - 3)) * ((nd + 1) * g2 + 6))


# ---------------------------------------------------------------- special functions

def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                + a * math.log(x) + b * math.log1p(-x))
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def gammaincc(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x)."""
    if x <= 0.0:
        return 1.0
    if x < s + 1.0:
        term = 1.0 / s
        total = term
        k = s
        for _ in range(100_000):
            k += 1.0
            term *= x / k
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1.0 - total * math.exp(-x + s * math.log(x) - math.lgamma(s)))
    tiny = 1e-300
    b = x + 1.0 - s
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return math.exp(-x + s * math.log(x) - math.lgamma(s)) * h


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


# Degrees of freedom from which Student's t is taken as a corrected normal.
LARGE_DF = 1e6


def t_two_sided_p(t: float, df: float) -> float:
    if t is None or df is None or not math.isfinite(t) or df <= 0:
        return float("nan")
    if df >= LARGE_DF:
        z = abs(t) * (1 - 1 / (4 * df)) / math.sqrt(1 + t * t / (2 * df))
        return 2 * norm_sf(z)
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_cdf(t: float, df: float) -> float:
    p = 0.5 * betainc(df / 2.0, 0.5, df / (df + t * t))
    return 1.0 - p if t > 0 else p


def t_ppf(q: float, df: float) -> float:
    """Quantile of Student's t: bisection on the CDF inside a bracket found by
    doubling; for many degrees of freedom the normal quantile with its first
    Cornish-Fisher terms."""
    if df >= LARGE_DF:
        z = NormalDist().inv_cdf(q)
        return z + (z ** 3 + z) / (4 * df) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * df * df)
    lo, hi = -1.0, 1.0
    while t_cdf(lo, df) > q:
        lo *= 2
    while t_cdf(hi, df) < q:
        hi *= 2
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_cdf(mid, df) < q:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def chi2_sf(x: float, dof: float) -> float:
    if x is None or dof is None or dof <= 0:
        return float("nan")
    return gammaincc(dof / 2.0, x / 2.0)


# ---------------------------------------------------------------- inverse normal

# Coefficients of Wichura's algorithm AS241 (highest power first)
# for the middle, the tails and the far tails of the normal quantile.
_MIDDLE = ((2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
            13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
           (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
            5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0))
_TAIL = ((0.000774545014278341407640, 0.0227238449892691845833, 0.241780725177450611770, 1.27045825245236838258,
          3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
         (0.00000000105075007164441684324, 0.000547593808499534494600, 0.0151986665636164571966, 0.148103976427480074590,
          0.689767334985100004550, 1.67638483018380384940, 2.05319162663775882187, 1.0))
_FAR = ((0.000000201033439929228813265, 0.0000271155556874348757815, 0.00124266094738807843860, 0.0265321895265761230930,
         0.296560571828504891230, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
        (0.00000000000000204426310338993978564, 0.000000142151175831644588870, 0.0000184631831751005468180, 0.000786869131145613259100,
         0.0148753612908506148525, 0.136929880922735805310, 0.599832206555887937690, 1.0))


def _ratio(parts: tuple, r: str) -> str:
    def horner(c: tuple) -> str:
        out = f"CAST({c[0]!r} AS DOUBLE)"
        for x in c[1:]:
            out = f"({out} * {r} + CAST({x!r} AS DOUBLE))"
        return out
    return f"({horner(parts[0])} / {horner(parts[1])})"


def inverse_normal_sql(p: str) -> str:
    """SQL text of the standard normal quantile of ``p`` (a column name, in
    (0, 1)); plain arithmetic, so any engine takes it."""
    q = f"({p} - 0.5)"
    r = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    tail = f"(CASE WHEN {r} <= 5.0 THEN {_ratio(_TAIL, f'({r} - 1.6)')} ELSE {_ratio(_FAR, f'({r} - 5.0)')} END)"
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {q} * {_ratio(_MIDDLE, f'(0.180625 - {q} * {q})')} "
            f"WHEN {q} < 0 THEN -{tail} ELSE {tail} END)")


# ---------------------------------------------------------------- Mann-Whitney

#: Largest n1 * n2 for which the null distribution of U is counted.
EXACT_U = 200_000


@lru_cache(maxsize=32)
def _u_counts(m: int, n: int) -> tuple[int, ...]:
    """How many ways two groups of m and n untied values give each U, up to the
    middle: coefficients of the product of (1 - q^(n+i)) / (1 - q^i)."""
    top = m * n // 2
    ways = [1] + [0] * top
    for i in range(1, m + 1):
        for k in range(top, n + i - 1, -1):
            ways[k] -= ways[k - n - i]
        for k in range(i, top + 1):
            ways[k] += ways[k - i]
    return tuple(ways)


def mann_whitney_exact_p(u: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value of U for groups without ties."""
    m, n = sorted((int(n1), int(n2)))
    low = int(min(u, n1 * n2 - u))
    ways = _u_counts(m, n)
    return min(1.0, 2.0 * (sum(ways[:low + 1]) / math.comb(m + n, m)))


def shapiro_francia_p(w: float, n: int) -> float:
    """Royston's normal approximation for the Shapiro-Francia statistic (made
    for 5 to 5,000 values; beyond that it is carried on)."""
    if n < 5 or w is None or not math.isfinite(w):
        return float("nan")
    if w >= 1.0:
        return 1.0
    u = math.log(n)
    v = math.log(u)
    return norm_sf((math.log(1.0 - w) + 1.2725 - 1.0521 * (v - u)) / (1.0308 - 0.26758 * (v + 2.0 / u)))
