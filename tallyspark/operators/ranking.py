"""Ranked reports over a fact table: totals, means, maxima with ties, leaders per group.

Every report is a ``groupBy().agg()`` (partial aggregation before the shuffle, so a hot
key costs one row per map task) followed by a sort of the *aggregated* rows. Where the
raw-row result is needed (maxima with ties), the aggregate is joined back on a key that
includes the measure, so no window ever holds a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.binned import exact_totals
from tallyspark.functions.columns import as_list, exclude_values
from tallyspark.functions.labels import magnitude_label
from tallyspark.operators.joins import materialize_small, stage, total_order


def top_with_ties(
    df: DataFrame,
    keys=("country_or_area", "flow"),
    measure: str = "trade_usd",
    out: str = "biggest_trade",
    exclude=None,
    label: bool = True,
) -> DataFrame:
    """Rows holding the maximum ``measure`` of their ``keys`` group, ties kept, with the
    maximum in ``out`` (labelled). A group whose measures are all null yields nothing.

    Plan: max per group (partial + final hash aggregate over the key and measure columns
    only, one row per group), written once and broadcast when the group count is bounded;
    then a left semi join of the rows on (keys, measure = max), which streams the rows
    without a shuffle. Past the bound it is a shuffle join whose key includes the measure,
    so a hot group spreads across tasks. The (small) result is written once before the
    global sort, so the big table is scanned twice in all, not three times.
    """
    keys = as_list(keys)
    src = exclude_values(df, exclude)
    maxima = materialize_small(src.groupBy(*keys).agg(F.max(measure).alias("__max")))
    renamed = maxima.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    cond = src[measure] == renamed["__max"]
    for k in keys:
        cond = cond & src[k].eqNullSafe(renamed[f"__k_{k}"])
    hits = src.join(renamed, on=cond, how="left_semi").withColumn(out, F.col(measure))
    # The hits are written before the sort: a global sort samples its input to pick range
    # bounds, and sampling the unshuffled scan + semi join would read the whole table again.
    hits, _ = stage(hits)
    ordered = hits.orderBy(*total_order(hits, F.col(out).desc()))
    return ordered.withColumn(out, magnitude_label(out)) if label else ordered


def ranked_totals(
    df: DataFrame,
    keys,
    measure: str,
    out: str = "overall_sum",
    exclude=None,
    label: bool = False,
) -> DataFrame:
    """Exact sum of ``measure`` per ``keys``, largest first; optionally labelled in place."""
    agg = exact_totals(exclude_values(df, exclude), as_list(keys), sums={out: measure})
    ordered = agg.orderBy(F.col(out).desc())
    return ordered.withColumn(out, magnitude_label(out)) if label else ordered


def ranked_means(
    df: DataFrame,
    keys="country",
    measure: str = "interest_rate",
    out: str = "avg_interest_rate",
) -> DataFrame:
    """Exact mean of ``measure`` per ``keys``, smallest first. A group with only null measures has
    a null mean and sorts first."""
    agg = exact_totals(df, as_list(keys), means={out: measure})
    return agg.orderBy(F.col(out).asc_nulls_first())


def leader_in_group(
    df: DataFrame,
    item: str = "commodity",
    group=("category", "flow"),
    measure: str = "trade_usd",
    exclude=None,
    total_out: str = "overall_sum",
    item_out: str = "sum_for_good",
    label: bool = True,
) -> DataFrame:
    """Per ``group``: the group total and the item(s) with the largest item total (ties kept).

    Aggregates the raw rows once per (item, group); the group totals and maxima come from
    those aggregated rows, never from a window over raw rows.
    """
    group = as_list(group)
    per_item = exclude_values(df, exclude).groupBy(item, *group).agg(F.sum(measure).alias(item_out))
    per_group = per_item.groupBy(*group).agg(
        F.sum(item_out).alias(total_out), F.max(item_out).alias("__top")
    )
    renamed = per_group.withColumnsRenamed({g: f"__g_{g}" for g in group})
    cond = per_item[item_out] == renamed["__top"]
    for g in group:
        cond = cond & per_item[g].eqNullSafe(renamed[f"__g_{g}"])
    # item first, then the group keys last-to-first: (commodity, flow, category, ...)
    leaders = per_item.join(renamed, on=cond, how="inner").select(item, *reversed(group), total_out, item_out)
    ordered = leaders.orderBy(F.col(total_out).desc())
    if not label:
        return ordered
    return ordered.withColumns({total_out: magnitude_label(total_out), item_out: magnitude_label(item_out)})


def period_totals(
    df: DataFrame,
    keys=("country_or_area", "flow", "year"),
    measure: str = "trade_usd",
    out: str = "overall_sum",
    label_out: str = "overall_sum_str",
    exclude=None,
) -> DataFrame:
    """One row per (``keys``) with the summed measure, largest first, and its label in a new
    column. One hash aggregate; the reference's window + distinct shuffles every raw row."""
    agg = exclude_values(df, exclude).groupBy(*as_list(keys)).agg(F.sum(measure).alias(out))
    return agg.orderBy(F.col(out).desc()).withColumn(label_out, magnitude_label(out))


def totals_since(
    df: DataFrame,
    flow_value: str,
    since: int,
    key: str = "country_or_area",
    flow: str = "flow",
    period: str = "year",
    measure: str = "trade_usd",
    out: str = "overall_sum",
    label_out: str = "overall_sum_str",
    exclude=None,
) -> DataFrame:
    """Total per ``key`` of one flow from period ``since`` on (period read as an integer;
    unparseable periods are dropped), largest first, labelled in a new column."""
    rows = exclude_values(df, exclude).filter(
        (F.col(period).try_cast("int") >= F.lit(since)) & (F.col(flow) == F.lit(flow_value))
    )
    agg = rows.groupBy(key, flow).agg(F.sum(measure).alias(out))
    return agg.orderBy(F.col(out).desc()).withColumn(label_out, magnitude_label(out))


__all__ = [
    "leader_in_group",
    "period_totals",
    "ranked_means",
    "ranked_totals",
    "top_with_ties",
    "totals_since",
]
