"""DataFrame-in, DataFrame-out operators. None of them creates a session, prints or collects."""

from tallyspark.operators.balance import balance, balance_by_period, balance_from_totals, balance_leaderboard
from tallyspark.operators.joins import broadcast_if_small, join_dimension, join_on_keys
from tallyspark.operators.lending import (
    blended_rate,
    group_profile,
    harmonize_columns,
    open_only,
    open_position,
    open_share_of_total,
    share_of_total,
)
from tallyspark.operators.market import (
    DailyPrices,
    attach_daily_map,
    coin_map_per_day,
    daily_basket,
    enrich_facts,
    peer_mean,
    period_comparison,
)
from tallyspark.operators.quality import clean_rows, distinct_values, duplicate_keys, duplicate_values
from tallyspark.operators.ranking import (
    leader_in_group,
    period_totals,
    ranked_means,
    ranked_totals,
    top_with_ties,
    totals_since,
)

__all__ = [
    "DailyPrices",
    "attach_daily_map",
    "balance",
    "balance_by_period",
    "balance_from_totals",
    "balance_leaderboard",
    "blended_rate",
    "broadcast_if_small",
    "clean_rows",
    "coin_map_per_day",
    "daily_basket",
    "distinct_values",
    "duplicate_keys",
    "duplicate_values",
    "enrich_facts",
    "group_profile",
    "harmonize_columns",
    "join_dimension",
    "join_on_keys",
    "leader_in_group",
    "open_only",
    "open_position",
    "open_share_of_total",
    "peer_mean",
    "period_comparison",
    "period_totals",
    "ranked_means",
    "ranked_totals",
    "share_of_total",
    "top_with_ties",
    "totals_since",
]
