"""Distribution functions for small arrays (p-values, quantile transforms)."""

from __future__ import annotations

import math
from functools import cache

import numpy as np


def chi2_sf(x: float, df: float) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma)."""
    if x <= 0:
        return 1.0
    a, z = df / 2.0, x / 2.0
    scale = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - total * scale)
    # continued fraction, modified Lentz
    b = z + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        c = b + an / c
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        step = d * (c if abs(c) > 1e-300 else 1e-300)
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return min(1.0, h * scale)


def normal_cdf(x):
    return 0.5 * np.vectorize(math.erfc, otypes=[float])(-np.asarray(x, float) / math.sqrt(2))


def normal_pdf(x):
    x = np.asarray(x, float)
    return np.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def normal_ppf(p):
    """Inverse normal: a logistic start refined by Newton steps on the distribution function."""
    p = np.asarray(p, float)
    upper = np.where(p > 0.5, 1 - p, p)
    t = np.sqrt(-2 * np.log(np.clip(upper, 1e-300, None)))
    x = -(t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t**3))
    for _ in range(4):
        error = normal_cdf(x) - upper
        x = x - error / np.maximum(normal_pdf(x), 1e-300)
    return np.where(p > 0.5, -x, x)


_quadrature = cache(np.polynomial.legendre.leggauss)


def bivariate_normal_cdf(h, k, rho: float, nodes: int = 48):
    """P(X<h, Y<k) by integrating the density over the correlation from 0 to rho."""
    h, k = np.broadcast_arrays(np.asarray(h, float), np.asarray(k, float))
    hc, kc = np.clip(h, -8, 8), np.clip(k, -8, 8)
    x, w = _quadrature(nodes)
    t = (x + 1) * rho / 2
    s = 1 - t * t
    q = (hc[..., None] ** 2 - 2 * hc[..., None] * kc[..., None] * t + kc[..., None] ** 2) / (2 * s)
    area = (np.exp(-q) / (2 * math.pi * np.sqrt(s)) * w).sum(-1) * rho / 2
    return np.clip(normal_cdf(hc) * normal_cdf(kc) + area, 0, 1)


def golden_max(f, low: float, high: float, tol: float = 1e-7) -> float:
    g = (math.sqrt(5) - 1) / 2
    a, b = low, high
    c, d = b - g * (b - a), a + g * (b - a)
    fc, fd = f(c), f(d)
    while b - a > tol:
        if fc >= fd:
            b, d, fd = d, c, fc
            c = b - g * (b - a)
            fc = f(c)
        else:
            a, c, fc = c, d, fd
            d = a + g * (b - a)
            fd = f(d)
    return (a + b) / 2
