"""Whole-number vectors for the operators that compare exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Squared norms below this keep inner products and squared distances inside 64 bits.
NORM_LIMIT = 2.0**60


def finite(vector: Column) -> Column:
    """No null vector, and no null or non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, lambda x: F.coalesce(bad(x), F.lit(True))), F.lit(False))


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def fits(whole_vector: Column) -> Column:
    """Whether exact products of the whole-number vector stay inside 64 bits."""
    square = F.aggregate(
        whole_vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    return square < NORM_LIMIT


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """An Arrow list column without nulls as a matrix of 64-bit integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
