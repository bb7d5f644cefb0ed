"""Integer vectors: usable rows, their range, and matrices of Arrow columns."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """A vector that is not null and has finite components alone."""
    number = lambda x: x.cast("double")
    return F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))


def scaled(column: str, scale: int, shift: int = 0) -> Column:
    """floor(scale * x) + shift of each component. Values beyond 2^62 stop there, for
    ``extent`` to find: Spark may evaluate this before the filter that drops them."""
    most = F.lit(1 << 62)
    return F.transform(column, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), most), -most) + shift)


class Extent(NamedTuple):
    rows: int
    width: int  # components of the longest vector
    shortest: int
    most: int  # largest absolute component


def extent(vectors: DataFrame, column: str = "v") -> Extent:
    """One pass over ``vectors``."""
    size = F.size(column)
    most = F.greatest(F.abs(F.array_max(column)), F.abs(F.array_min(column)))
    row = vectors.agg(F.count("*"), F.max(size), F.min(size), F.max(most)).first()
    return Extent(*(int(x or 0) for x in row))


def require_range(found: Extent, limit: int) -> None:
    """An inner product must stay below ``limit``; larger components are an error, not
    a wrong answer."""
    if found.width * found.most**2 >= limit:
        raise ValueError(f"components up to {found.most} in {found.width} dimensions leave the range of exact scores")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as a matrix of 64-bit integers; missing components are 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out
