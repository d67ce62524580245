"""Tail probabilities of the t and F distributions, for regression reports.

Applied on the driver side of a fit or inside a task to one value per model.
"""

from __future__ import annotations

import math


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by its continued fraction (modified Lentz)."""
    if not 0.0 < x < 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    total = d
    for m in range(1, 500):
        step = 1.0
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            step *= c * d
        total *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * total


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > |t|)."""
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t)) if math.isfinite(t) else 0.0


def f_upper(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    return incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if math.isfinite(f) else 0.0


def t_quantile_two_sided(alpha: float, dof: float) -> float:
    """t with P(|T| > t) = alpha, by bisection."""
    low, high = 0.0, 1.0
    while t_two_sided(high, dof) > alpha:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if t_two_sided(mid, dof) > alpha else (low, mid)
    return (low + high) / 2
