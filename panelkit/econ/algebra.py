"""Small symmetric systems on the driver; their size is the number of regressors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def moment_columns(names: Sequence[str], weight: Column | None = None) -> list[Column]:
    """Aggregates for the sums of all products of two columns, as ``m_<i>_<j>``."""
    out = []
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            product = F.col(a) * F.col(names[j])
            out.append(F.sum(product if weight is None else product * weight).alias(f"m_{i}_{j}"))
    return out


def moment_matrix(row: Mapping[str, float], size: int) -> np.ndarray:
    """The symmetric matrix behind one row of ``moment_columns``."""
    out = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            out[i, j] = out[j, i] = row[f"m_{i}_{j}"] or 0.0
    return out


def inverse(matrix: np.ndarray) -> np.ndarray:
    """Inverse of a moment matrix, scaled to unit diagonal for accuracy."""
    scale = np.sqrt(np.diag(matrix))
    if not np.all(scale > 0):
        raise ValueError("a regressor has no variation left after absorbing the effects")
    unit = matrix / np.outer(scale, scale)
    if np.linalg.cond(unit) > 1e13:
        raise ValueError("the regressors are collinear")
    return np.linalg.inv(unit) / np.outer(scale, scale)
