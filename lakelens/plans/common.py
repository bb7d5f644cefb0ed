"""Shared helpers for registered jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def r6(c) -> Column:
    """Round a double for comparison with the SQL oracle. Rounding to 10 places
    first snaps summation-order noise, so ties round alike in both engines."""
    return F.round(F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 10), DIGITS)


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every DOUBLE/FLOAT column to ``DIGITS`` places, keep the rest."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(r6(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def sql_r6(expr: str) -> str:
    return f"round(round(CAST({expr} AS DOUBLE), 10), {DIGITS})"
