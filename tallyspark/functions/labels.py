"""Money labels (T2): a long rendered as ``<n> tri`` / ``<n> bil`` / ``<n> mil`` or plain digits.

Built from native expressions (integral ``div``, ``abs``, ``concat``) so it stays inside
whole-stage codegen; no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.columns import as_col

# The label thresholds and suffixes, largest first.
MAGNITUDES = (
    (1_000_000_000_000, "tri"),
    (1_000_000_000, "bil"),
    (1_000_000, "mil"),
)


def magnitude_label(value) -> Column:
    """Label a long by magnitude. Division truncates toward zero and keeps the sign, so
    ``-1_500_000_000`` is ``"-1 bil"``. Null stays null."""
    x = as_col(value).cast("long")
    label = x.cast("string")
    for factor, suffix in reversed(MAGNITUDES):
        quotient = F.call_function("div", x, F.lit(factor))
        label = F.when(F.abs(quotient) > 0, F.concat(quotient.cast("string"), F.lit(" " + suffix))).otherwise(label)
    return label


def magnitude_label_sql(expr: str) -> str:
    """The same label as an ANSI ``CASE`` over SQL text (used by the DuckDB oracle)."""
    parts = []
    for factor, suffix in MAGNITUDES:
        q = f"(({expr}) // {factor})"
        parts.append(f"WHEN abs({q}) > 0 THEN CAST({q} AS VARCHAR) || ' {suffix}'")
    return f"(CASE {' '.join(parts)} ELSE CAST(({expr}) AS VARCHAR) END)"
