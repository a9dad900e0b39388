"""Lending reports: share of total (L2/L5), group profile (L4), open position (L6), blended
rate across two feeds (L7) and column harmonisation (L8).

All per-key figures are one aggregation, exact whatever the row order. The worldwide total is a scalar subquery over the
aggregated rows (one value, executed once and inlined), not an empty ``over()`` window that
would pull every row into one partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.binned import exact_totals
from tallyspark.functions.columns import percent_of
from tallyspark.functions.dates import LOAN_DATE_FORMAT, days_until, parse_date

# Statuses of loans that are no longer open.
CLOSED_STATUSES = ("Fully Repaid", "Fully Cancelled")

# The credit feed's column names and their common names.
CREDIT_TO_LOAN_COLUMNS = {
    "service_charge_rate": "interest_rate",
    "credit_status": "loan_status",
}


def open_only(df: DataFrame, status: str = "loan_status", closed=CLOSED_STATUSES) -> DataFrame:
    """Rows whose status is not a closed one. A null status is dropped (``<>`` semantics)."""
    return df.filter(~F.col(status).isin(*closed))


def share_of_total(
    df: DataFrame,
    key: str = "country",
    measure: str = "original_principal_amount",
    out: str = "total_loans_amount",
    total_out: str = "total_loans_worldwide",
    percent_out: str = "percenteage_from_worldwide",
) -> DataFrame:
    """Total per ``key``, the grand total and the key's percentage of it, largest first.
    A zero grand total gives a null percentage."""
    per_key = exact_totals(df, [key], sums={out: measure})
    grand_total = exact_totals(per_key, [], sums={total_out: out}).scalar()
    return (
        per_key.withColumn(total_out, grand_total)
        .withColumn(percent_out, percent_of(out, total_out))
        .orderBy(F.col(out).desc())
    )


def open_share_of_total(df: DataFrame, status: str = "loan_status", closed=CLOSED_STATUSES, **kwargs) -> DataFrame:
    """``share_of_total`` over open loans only."""
    return share_of_total(open_only(df, status, closed), **kwargs)


def group_profile(
    df: DataFrame,
    key: str = "country",
    measure: str = "original_principal_amount",
    rate: str = "interest_rate",
) -> DataFrame:
    """Per ``key``: number of loans (``count(key)``, so the null-key group counts 0), exact mean
    rate and total amount; lowest mean rate first."""
    return (
        exact_totals(
            df,
            [key],
            sums={"total_loans_amount": measure},
            means={"avg_interest_rate": rate},
            counts={"number_of_loans": key},
        )
        .select(key, "number_of_loans", "avg_interest_rate", "total_loans_amount")
        .orderBy(F.col("avg_interest_rate").asc_nulls_first())
    )


def open_position(
    df: DataFrame,
    key: str = "country",
    measure: str = "original_principal_amount",
    rate: str = "interest_rate",
    due: str = "last_repayment_date",
    due_format: str = LOAN_DATE_FORMAT,
    status: str = "loan_status",
    closed=CLOSED_STATUSES,
) -> DataFrame:
    """Open loans per ``key``: total amount, mean rate and the latest repayment date (text
    parsed as a date first, so the maximum is a date maximum); largest total first."""
    dated = open_only(df, status, closed).withColumn("due_date", parse_date(due, due_format))
    return (
        exact_totals(
            dated,
            [key],
            sums={"total_loans_amount": measure},
            means={"avg_interest_rate": rate},
            maxima={"due_date": "due_date"},
        )
        .select(key, "total_loans_amount", "avg_interest_rate", "due_date")
        .orderBy(F.col("total_loans_amount").desc())
    )


def blended_rate(
    first: DataFrame,
    second: DataFrame,
    as_of,
    key: str = "country",
    names=("ibrd", "ida"),
    rate_digits: int = 3,
) -> DataFrame:
    """Join two ``open_position`` results on ``key`` and blend their rates.

    Each side's rate is rounded to ``rate_digits``; its weight is
    ``days(as_of → due) × rate × amount``; the blended rate is ``Σ rate × weight / Σ weight``
    rounded to ``rate_digits`` (null when the weights sum to zero). Both inputs hold one row
    per key, so this join is of aggregated rows.
    """
    a, b = names

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            key,
            F.col("total_loans_amount").alias(f"{name}_loans"),
            F.round("avg_interest_rate", rate_digits).alias(f"{name}_interest_rate"),
            F.col("due_date").alias(f"{name}_due_date"),
        )

    joined = side(first, a).join(side(second, b), on=key, how="inner")
    weights = {
        f"{n}_part": days_until(f"{n}_due_date", as_of) * F.col(f"{n}_interest_rate") * F.col(f"{n}_loans")
        for n in names
    }
    joined = joined.withColumns(weights).withColumn("__sum_part", F.col(f"{a}_part") + F.col(f"{b}_part"))
    blended = F.try_divide(F.col(f"{a}_interest_rate") * F.col(f"{a}_part"), F.col("__sum_part")) + F.try_divide(
        F.col(f"{b}_interest_rate") * F.col(f"{b}_part"), F.col("__sum_part")
    )
    return (
        joined.withColumn("total_loans_amount", F.col(f"{a}_loans") + F.col(f"{b}_loans"))
        .withColumn("avg_interest_rate", F.round(blended, rate_digits))
        .select(
            key,
            f"{a}_loans",
            f"{a}_interest_rate",
            f"{b}_loans",
            f"{b}_interest_rate",
            "total_loans_amount",
            "avg_interest_rate",
        )
        .orderBy(F.col("total_loans_amount").desc())
    )


def harmonize_columns(df: DataFrame, mapping: Mapping[str, str] = CREDIT_TO_LOAN_COLUMNS) -> DataFrame:
    """Rename feed-specific columns to the common schema (missing ones are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


__all__ = [
    "CLOSED_STATUSES",
    "CREDIT_TO_LOAN_COLUMNS",
    "blended_rate",
    "group_profile",
    "harmonize_columns",
    "open_only",
    "open_position",
    "open_share_of_total",
    "share_of_total",
]
