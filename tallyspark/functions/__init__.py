"""Column-level functions: labels, dates, ratios, casts."""

from tallyspark.functions.binned import exact_totals, final_totals, partial_totals
from tallyspark.functions.columns import (
    as_col,
    cast_columns,
    exclude_values,
    null_safe_on,
    percent_of,
    safe_ratio,
)
from tallyspark.functions.dates import LOAN_DATE_FORMAT, as_of_literal, days_until, epoch_seconds, parse_date
from tallyspark.functions.labels import MAGNITUDES, magnitude_label, magnitude_label_sql

__all__ = [
    "LOAN_DATE_FORMAT",
    "MAGNITUDES",
    "as_col",
    "as_of_literal",
    "cast_columns",
    "days_until",
    "epoch_seconds",
    "exact_totals",
    "exclude_values",
    "final_totals",
    "magnitude_label",
    "magnitude_label_sql",
    "null_safe_on",
    "parse_date",
    "partial_totals",
    "percent_of",
    "safe_ratio",
]
