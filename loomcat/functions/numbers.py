"""Vectors, identifiers and hashes over columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """In [0, 2]; null for null, unequal lengths or a zero vector."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    distance = F.least(F.greatest(1 - dot(a, b) / norm, F.lit(0.0)), F.lit(2.0))
    return F.when((F.size(a) == F.size(b)) & (norm > 0), distance)


def is_gtin(code: Column) -> Column:
    """8, 12, 13 or 14 digits whose weighted sum is a multiple of ten."""
    n = F.length(code)
    digit = lambda i: F.substring(code, i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + digit(i) * F.when((n - i) % 2 == 1, 3).otherwise(1))
    return F.when(F.rlike(code, F.lit(r"^(\d{8}|\d{12,14})$")), total % 10 == 0).otherwise(F.lit(False))


def stable_hash(*columns: Column) -> Column:
    """SHA-256 over the values in order; nulls are told from empty texts."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def _ordered(bits: np.ndarray) -> np.ndarray:
    """The bits of doubles as whole numbers in the order of the doubles, and back."""
    return np.where(bits < 0, np.iinfo(np.int64).min - bits, bits)


def least_above(values: np.ndarray, gap: float) -> np.ndarray:
    low, high = _ordered(values.view(np.int64)), _ordered(np.full(len(values), np.inf).view(np.int64))
    with np.errstate(over="ignore"):  # a difference beyond the doubles is infinite, which is at least ``gap``
        for _ in range(64):
            mid = (low & high) + ((low ^ high) >> 1)
            far = _ordered(mid).view(np.float64) - values >= gap
            low, high = np.where(far, low, mid), np.where(far, mid, high)
    return _ordered(high).view(np.float64)


def first_apart(value: Column, gap: float) -> Column:
    """The least double from which ``value``, which is finite, subtracts to ``gap`` or more: differences of doubles are
    rounded, so ``value + gap`` may miss it. The session's workers need the package: call ``shipping.ship``."""

    @F.pandas_udf("double")
    def read(values: pd.Series) -> pd.Series:
        return pd.Series(least_above(values.to_numpy(np.float64, copy=True), gap))

    return read(value)
