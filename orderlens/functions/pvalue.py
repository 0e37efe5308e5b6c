"""Two-sided p-value of a Pearson correlation (t-test with n-2 degrees of freedom).

p = I_x(df/2, 1/2) with x = df / (df + t^2), t^2 = r^2 df / (1 - r^2): the regularized
incomplete beta function, evaluated by its continued fraction (modified Lentz), vectorised over
numpy arrays so that it runs inside an Arrow-batched pandas UDF. The same formula serves every number
of pairs; a fraction that does not settle is an error, never a rough value.
"""

from __future__ import annotations

import math

import numpy as np

_TINY = 1e-300
_EPS = 1e-15
_MAX_ITER = 200_000  # the fraction needs about the root of the degrees of freedom

_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    done = np.zeros(x.shape, dtype=bool)
    for m in range(1, _MAX_ITER + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = np.where(done, h, h * d * c)
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = np.where(done, h, h * delta)
        done |= np.abs(delta - 1.0) < _EPS
        if done.all():
            return h
    raise ArithmeticError("the continued fraction of the incomplete beta function did not settle")


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln B(a, b). Next to a large parameter 1/2 goes through the series of
    ln gamma(x + 1/2) - ln gamma(x), as a difference of large logarithms loses digits."""
    x = np.maximum(a, b)
    big = (np.minimum(a, b) == 0.5) & (x > 200.0)
    y = np.where(big, x, 1.0)
    gap = 0.5 * np.log(y) - 1 / (8 * y) + 1 / (192 * y**3) - 1 / (640 * y**5)
    return np.where(big, _lgamma(0.5) - gap, _lgamma(a) + _lgamma(b) - _lgamma(a + b))


def betainc(a, b, x) -> np.ndarray:
    """Regularized incomplete beta I_x(a, b) for arrays (0 <= x <= 1)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.where(x <= 0.0, 0.0, 1.0)
    inner = (x > 0.0) & (x < 1.0)
    if not inner.any():
        return out
    a_, b_, x_ = a[inner], b[inner], x[inner]
    front = np.exp(-_log_beta(a_, b_) + a_ * np.log(x_) + b_ * np.log1p(-x_))
    direct = x_ < (a_ + 1.0) / (a_ + b_ + 2.0)
    res = np.empty_like(x_)
    if direct.any():
        res[direct] = front[direct] * _betacf(a_[direct], b_[direct], x_[direct]) / a_[direct]
    if (~direct).any():
        nd = ~direct
        res[nd] = 1.0 - front[nd] * _betacf(b_[nd], a_[nd], 1.0 - x_[nd]) / b_[nd]
    out[inner] = res
    return out


def pearson_pvalue(r, n) -> np.ndarray:
    """Two-sided p-value for correlation ``r`` over ``n`` pairs; NaN when undefined."""
    r = np.asarray(r, dtype=float)
    n = np.asarray(n, dtype=float)
    r, n = np.broadcast_arrays(r, n)
    p = np.full(r.shape, np.nan)
    ok = np.isfinite(r) & (n > 2)
    if not ok.any():
        return p
    rr = np.clip(np.abs(r[ok]), 0.0, 1.0)
    df = n[ok] - 2.0
    res = np.zeros(rr.shape)
    part = rr < 1.0
    if part.any():
        x = 1.0 - rr[part] ** 2  # = df / (df + t^2)
        res[part] = betainc(df[part] / 2.0, 0.5, x)
    p[ok] = np.clip(res, 0.0, 1.0)
    return p
