"""Small numpy pieces of least squares that the distributed jobs call on one group's moments or survey rows."""

from __future__ import annotations

import numpy as np


def solve(n: int, mean: np.ndarray, cov: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray]:
    """(intercept, beta, sigma, inverse) of least squares; of minimal norm if the predictors are dependent.

    sigma is null (nan) without degrees of freedom; inverse is of the centred X'X, for prediction errors.
    """
    k = len(mean) - 1
    sxx, sxy = cov[1:, 1:] * n, cov[1:, 0] * n
    inverse = np.linalg.pinv(sxx, rcond=1e-12, hermitian=True)
    beta = inverse @ sxy
    sse = max(0.0, cov[0, 0] * n - beta @ sxy)
    sigma = np.sqrt(sse / (n - k - 1)) if n > k + 1 else np.nan
    return float(mean[0] - beta @ mean[1:]), beta, float(sigma), inverse


def adjusted(r2: float, n: int, k: int) -> float:
    return 1 - (1 - r2) * (n - 1) / (n - k - 1) if n > k + 1 else -np.inf


def r2_of(y: np.ndarray, p: np.ndarray) -> float:
    """Squared correlation; zero where one side doesn't vary."""
    if len(y) < 2 or y.std() == 0 or p.std() == 0:
        return 0.0
    r = float(np.corrcoef(y, p)[0, 1])
    return r * r if np.isfinite(r) else 0.0


def lstsq(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
