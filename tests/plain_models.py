"""Selection, validation and prediction refitted row by row in numpy, as the rules say it."""

from itertools import combinations

import numpy as np


def lstsq(x, y):
    return np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]


def r2_of(y, p):
    if len(y) < 2 or np.std(y) == 0 or np.std(p) == 0:
        return 0.0
    return float(np.corrcoef(y, p)[0, 1] ** 2)


def grow(x, y, x_out, y_out, use):
    """Stations by r² of the refit while the held-out RMSE doesn't rise and fewer than n - 1 are used."""
    chosen, best = [], np.inf
    while len(chosen) < len(y) - 1:
        scores = {}
        for i in [i for i in use if i not in chosen]:
            b = lstsq(x[:, [*chosen, i]], y)
            scores[i] = round(r2_of(y, b[0] + x[:, [*chosen, i]] @ b[1:]), 12)
        if not scores:
            break
        new = [*chosen, max(scores, key=lambda i: (scores[i], -i))]
        b = lstsq(x[:, new], y)
        error = np.sqrt(np.mean((b[0] + x_out[:, new] @ b[1:] - y_out) ** 2))
        if error > best * (1 + 1e-10):
            break
        best, chosen = error, new
    return chosen


def loyo(dates, x, y, use=None):
    """(prediction by row, features by year), negatives as zero."""
    years, pred, features = np.array([d.year for d in dates]), np.zeros(len(y)), {}
    x = np.nan_to_num(x)
    for f in sorted(set(years)):
        out = years == f
        features[f] = [] if out.all() else grow(x[~out], y[~out], x[out], y[out], range(x.shape[1]) if use is None else use)
        if features[f]:
            b = lstsq(x[~out][:, features[f]], y[~out])
            pred[out] = np.maximum(b[0] + x[out][:, features[f]] @ b[1:], 0)
    return pred, features


def loo_score(x, y):
    p = np.empty(len(y))
    for i in range(len(y)):
        rest = np.arange(len(y)) != i
        b = lstsq(x[rest], y[rest])
        p[i] = max(0.0, b[0] + x[i] @ b[1:])
    n, k = x.shape
    return 1 - (1 - r2_of(y, p)) * (n - 1) / (n - k - 1) if n > k + 1 else -np.inf


def best_subset(x, y, features, most=5):
    used = sorted({f for own in features.values() for f in own})
    x = np.nan_to_num(x)
    scored = [(loo_score(x[:, list(s)], y), list(s)) for k in range(1, most + 1) for s in combinations(used, k)]
    top = max(s for s, _ in scored) if scored else None
    return [s for v, s in scored if v > top - 1e-9], top


def final_fit(x, y, chosen, zero_row=True):
    x = x[:, chosen]
    ok = ~np.isnan(x).any(axis=1)
    x, y = x[ok], y[ok]
    return lstsq(np.vstack([x, np.zeros(len(chosen))]), np.append(y, 0.0)) if zero_row else lstsq(x, y)
