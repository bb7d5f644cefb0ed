"""Orderings and paging (O-2 .. O-4, O-7). Output order matters only for
presentation; every operator that depends on order carries an explicit
sequence column instead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of


def newest_first(df: DataFrame, ts: str, *tie: str) -> DataFrame:
    """O-2: newest rows first (ties by the given columns)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c) for c in tie])


def priority(c, order: Sequence[str]) -> Column:
    """O-3: rank of a value in a custom order (CASE ...); unknown values last."""
    expr = None
    for i, v in enumerate(order):
        expr = F.when(col_of(c) == v, F.lit(i)) if expr is None else expr.when(col_of(c) == v, F.lit(i))
    return expr.otherwise(F.lit(len(order))) if expr is not None else F.lit(0)


def page(df: DataFrame, order: Sequence[Column], size: int, number: int) -> DataFrame:
    """O-4: one page of a sorted result (``offset`` + ``limit``). Meant for
    reports; a full scan should never be read page by page."""
    return df.orderBy(*order).offset(size * number).limit(size)


def sorted_ids(c) -> Column:
    """O-7: sorted, de-duplicated id list."""
    return F.array_sort(F.array_distinct(col_of(c)))
