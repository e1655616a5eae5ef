"""Missing values: NULL inside the engine, NaN only at its edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def null_if_bad(c: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every float and double column of df with NaN as NULL."""
    kinds = (T.DoubleType, T.FloatType)
    return df.withColumns({f.name: null_if_nan(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, kinds)})


def or_default(c: Column, default: float) -> Column:
    """c unless it is NULL or 0."""
    return F.coalesce(F.nullif(c, F.lit(0.0)), F.lit(default))
