"""The fit once more in plain numpy, row by row, for comparison."""

import math

import numpy as np


def digamma(x):
    out = 0.0
    while x < 12:
        out -= 1 / x
        x += 1
    return out + math.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)


def fit(x, k, steps, gamma=0.001, reg=1e-6):
    x = np.sort(np.asarray(x, float))
    n = len(x)
    m0, psi = x.mean(), x.var(ddof=1)
    values, where, counts = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts / 2) / n
    bins = np.minimum(k - 1, np.floor(rank * k)).astype(int)
    r = np.eye(k)[bins][where]
    bounds = []

    def maximise(r):
        nk = r.sum(0) + 10 * np.finfo(float).eps
        mean = (r * x[:, None]).sum(0) / nk
        spread = (r * (x[:, None] - mean) ** 2).sum(0) / nk + reg
        beta, nu, a = 1 + nk, 1 + nk, 1 + nk
        b = gamma + np.array([nk[i + 1 :].sum() for i in range(k)])
        m = (m0 + nk * mean) / beta
        c = (psi + nk * spread + nk / beta * (mean - m0) ** 2) / nu
        return beta, nu, a, b, m, c

    def logs(p):
        beta, nu, a, b, m, c = p
        stick = [
            digamma(a[i]) - digamma(a[i] + b[i])
            + sum(digamma(b[j]) - digamma(a[j] + b[j]) for j in range(i))
            for i in range(k)
        ]
        dens = -0.5 * (math.log(2 * math.pi) + (x[:, None] - m) ** 2 / c + np.log(c) + np.log(nu))
        extra = 0.5 * (math.log(2) + np.array([digamma(v / 2) for v in nu]) - 1 / beta)
        return dens + extra + np.array(stick)

    p = maximise(r)
    for _ in range(steps):
        l = logs(p)
        top = l.max(1, keepdims=True)
        norm = top + np.log(np.exp(l - top).sum(1, keepdims=True))
        r = np.exp(l - norm)
        p = maximise(r)
        beta, nu, a, b, m, c = p
        half = -0.5 * np.log(c) - 0.5 * np.log(nu)
        wishart = -(nu * half + nu * 0.5 * math.log(2) + [math.lgamma(v / 2) for v in nu])
        lbeta = sum(math.lgamma(u) + math.lgamma(v) - math.lgamma(u + v) for u, v in zip(a, b))
        entropy = -(r * (l - norm)).sum()
        bounds.append(entropy - wishart.sum() + lbeta - 0.5 * np.log(beta).sum())
    return p, bounds
