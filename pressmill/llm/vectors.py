"""Vectors that take part in searches and joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(docs: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(_id, _vector)`` of the usable rows with an id."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), vector.alias("_vector")) \
        .where(F.col("_id").isNotNull() & usable(F.col("_vector")))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest part first, so that squares neither vanish nor overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
