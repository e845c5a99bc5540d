"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """True for a vector without missing and non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vec, finite), F.lit(False))


def matrix(rows, width: int, kind=np.float64) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled up with zeros."""
    out = np.zeros((len(rows), width), kind)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out
