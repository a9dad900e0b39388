"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def as_list(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def exclude_values(df: DataFrame, exclude: Mapping[str, object] | None) -> DataFrame:
    """Drop rows equal to a sentinel per column, with SQL ``<>`` semantics: a null in the
    column is dropped as well, as ``NULL <> x`` is not true."""
    for column, value in (exclude or {}).items():
        df = df.filter(F.col(column) != F.lit(value))
    return df


def safe_ratio(numerator, denominator) -> Column:
    """``numerator / denominator`` that is null (not an ANSI error) for a zero denominator."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def percent_of(part, whole) -> Column:
    return safe_ratio(part, whole) * F.lit(100)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast named columns once at ingest (text feeds become numbers/dates here, not in every
    comparison). Unparseable text becomes null instead of failing the job."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def null_safe_on(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """Join condition matching keys with ``<=>`` so a null key meets its null partner, the
    way a window partition or group-by treats null."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond
