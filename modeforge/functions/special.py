"""digamma for the handful of scalars an update step needs on the driver."""

from __future__ import annotations

import math


def digamma(x: float) -> float:
    """Logarithmic derivative of the gamma function for x > 0.

    Recurrence up to 8, then the asymptotic series (error below 1e-12 there).
    """
    if x <= 0:
        raise ValueError("digamma needs a positive argument")
    shift = 0.0
    while x < 8.0:
        shift -= 1.0 / x
        x += 1.0
    inv2 = 1.0 / (x * x)
    series = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return shift + math.log(x) - 0.5 / x - series


def log_beta(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
