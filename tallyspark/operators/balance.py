"""Two-sided balances (exports − imports): overall (T10), leaderboard (T11), per period (T12).

Both sides come from one pass: a group-by with conditional sums and counts. The reference
derives each side in its own job and joins them; that reads the table twice and shuffles
both results. ``balance_from_totals`` keeps the join form for callers that already hold the
two ranked lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.columns import exclude_values
from tallyspark.functions.labels import magnitude_label

# The two flow names of the trade feed.
EXPORT = "Export"
IMPORT = "Import"


def _side(flow: str, value: str, measure: str):
    return F.when(F.col(flow) == F.lit(value), F.col(measure))


def balance(
    df: DataFrame,
    since: int,
    key: str = "country_or_area",
    flow: str = "flow",
    period: str = "year",
    measure: str = "trade_usd",
    export_value: str = EXPORT,
    import_value: str = IMPORT,
    exclude=None,
) -> DataFrame:
    """Per ``key`` from period ``since`` on: export total, import total and
    ``saldo = export − import`` (labelled in ``saldo_str``), ordered by key.

    A key is kept when it has at least one row on each side (an inner join of the two
    sides keeps it too); a side whose measures are all null gives a null total and saldo.
    """
    rows = exclude_values(df, exclude).filter(
        (F.col(period).try_cast("int") >= F.lit(since))
        & F.col(flow).isin(export_value, import_value)
        & F.col(key).isNotNull()
    )
    sides = rows.groupBy(key).agg(
        F.sum(_side(flow, export_value, measure)).alias("overall_export"),
        F.sum(_side(flow, import_value, measure)).alias("overall_import"),
        F.count(F.when(F.col(flow) == F.lit(export_value), F.lit(1))).alias("__n_export"),
        F.count(F.when(F.col(flow) == F.lit(import_value), F.lit(1))).alias("__n_import"),
    )
    both = sides.filter((F.col("__n_export") > 0) & (F.col("__n_import") > 0))
    return (
        both.select(key, "overall_export", "overall_import")
        .withColumn("saldo", F.col("overall_export") - F.col("overall_import"))
        .withColumn("saldo_str", magnitude_label("saldo"))
        .orderBy(F.col(key).asc())
    )


def balance_from_totals(
    export_totals: DataFrame,
    import_totals: DataFrame,
    key: str = "country_or_area",
    total: str = "overall_sum",
) -> DataFrame:
    """Join form: inner join of an export ranking and an import ranking (as produced by
    ``totals_since``) on ``key``. Both inputs are already one row per key."""
    exports = export_totals.select(key, F.col(total).alias("overall_export"))
    imports = import_totals.select(key, F.col(total).alias("overall_import"))
    return (
        exports.join(imports, on=key, how="inner")
        .withColumn("saldo", F.col("overall_export") - F.col("overall_import"))
        .withColumn("saldo_str", magnitude_label("saldo"))
        .orderBy(F.col(key).asc())
    )


def balance_leaderboard(balances: DataFrame, n: int = 200, key: str = "country_or_area") -> DataFrame:
    """The ``n`` largest balances (a top-k report: the limit is the feature). Ties broken by
    key so the cut is deterministic; planned as TakeOrderedAndProject (per-task top-n, then
    one merge of at most n rows per task)."""
    return balances.orderBy(F.col("saldo").desc_nulls_last(), F.col(key).asc()).limit(n)


def balance_by_period(
    df: DataFrame,
    country: str | None = None,
    key: str = "country_or_area",
    period: str = "year",
    flow: str = "flow",
    measure: str = "trade_usd",
    export_value: str = EXPORT,
    import_value: str = IMPORT,
    exclude=None,
) -> DataFrame:
    """Per (``key``, ``period``): ``export_total``, ``import_total``, ``saldo`` and its label;
    periods without both sides (or with a null side total) are dropped. ``country`` limits
    the report to one key; by default every key is reported in the same job."""
    rows = exclude_values(df, exclude).filter(F.col(flow).isin(export_value, import_value))
    if country is not None:
        rows = rows.filter(F.col(key) == F.lit(country))
    per_period = rows.groupBy(key, period).agg(
        F.sum(_side(flow, export_value, measure)).alias("export_total"),
        F.sum(_side(flow, import_value, measure)).alias("import_total"),
    )
    return (
        per_period.withColumn("saldo", F.col("export_total") - F.col("import_total"))
        .filter(F.col("saldo").isNotNull())
        .withColumn("saldo_str", magnitude_label("saldo"))
        .orderBy(F.col(period).asc(), F.col(key).asc())
    )


__all__ = ["EXPORT", "IMPORT", "balance", "balance_by_period", "balance_from_totals", "balance_leaderboard"]
