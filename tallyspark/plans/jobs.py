"""Whole jobs: the reference's entry points as functions over the caller's files.

Each job ingests its feed once (CSV → Parquet copy under ``out_dir``), then returns its
reports by name (``Reports``); nothing is printed or collected. A report is built when it is first
asked for, so a caller who wants one runs no job of the others, and what several share is built
once. A caller writes or shows what it needs, and Spark runs each report as its own plan.
Feeds are read once where a schema is given; without one, types are inferred in one more pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyspark.functions.columns import cast_columns
from tallyspark.operators import (
    DailyPrices,
    balance,
    balance_by_period,
    balance_leaderboard,
    blended_rate,
    clean_rows,
    daily_basket,
    duplicate_keys,
    duplicate_values,
    enrich_facts,
    group_profile,
    harmonize_columns,
    leader_in_group,
    open_position,
    open_share_of_total,
    period_comparison,
    period_totals,
    ranked_means,
    ranked_totals,
    share_of_total,
    top_with_ties,
    totals_since,
)
from tallyspark.operators.joins import total_order
from tallyspark.scratch import Scratch, session_scratch
from tallyspark.sources.files import load_tables, materialize_parquet, read_csv
from tallyspark.streaming.snapshots import fresh_snapshots, running_totals, snapshot_stream, start_totals

# The roll-up sentinels of the trade feed, per column.
TRADE_TOTAL_CODE = {"comm_code": "TOTAL"}
TRADE_ALL_COMMODITIES = {"commodity": "ALL COMMODITIES"}
TRADE_ALL_CATEGORIES = {"category": "all_commodities"}

# The file stems of the rates/prices feed and its numeric columns.
MARKET_TABLES = {
    "rates": "FACT_CRYPTO_RATE",
    "coins": "DIM_CRYPTO_DATA",
    "prices": "FACT_GPU_PRICE",
    "products": "DIM_GPU_PROD",
    "days": "DIM_TIME",
}
MARKET_TYPES = {
    "FACT_CRYPTO_RATE": {"Open": "double", "Close": "double", "High": "double", "Low": "double"},
    "DIM_CRYPTO_DATA": {"Is_Mineable": "int"},
    "FACT_GPU_PRICE": {"Price_USD": "double", "Price_Original": "double"},
    "DIM_GPU_PROD": {"Memory_Capacity": "double"},
    "DIM_TIME": {"Year": "int"},
}


class Reports(Mapping[str, DataFrame]):
    """Reports by name, each built at its first use. The intermediates they wrote belong to the
    reports and are deleted by ``close``, or at the end of a ``with`` block, when nothing reads
    the reports any more; else at exit."""

    def __init__(self, spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]]):
        self._scratch = Scratch(spark)
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        session_scratch(spark).after(self._scratch)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            with self._scratch.building():
                self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def close(self) -> None:
        self._built.clear()
        self._scratch.close()

    def __enter__(self) -> Reports:
        return self

    def __exit__(self, *failure) -> None:
        self.close()


def trade_reports(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    since: int = 2010,
    leaderboard_size: int = 200,
    countries: Iterable[str] | None = None,
    schema=None,
) -> Reports:
    """Commodity trade reports over a header CSV (types given by ``schema`` or inferred once, kept
    as Parquet)."""
    trades = clean_rows(materialize_parquet(spark, csv_path, out_dir, schema=schema))

    @cache
    def balances() -> DataFrame:
        return balance(trades, since)

    def totals(item: str, exclude: Mapping[str, str]) -> DataFrame:
        return ranked_totals(trades, [item, "flow"], "trade_usd", exclude=exclude, label=True)

    builders = {
        "clean_rows": lambda: trades,
        "top_with_ties": lambda: top_with_ties(trades, exclude=TRADE_TOTAL_CODE),
        "ranked_totals_commodity": lambda: totals("commodity", TRADE_ALL_COMMODITIES),
        "ranked_totals_category": lambda: totals("category", TRADE_ALL_CATEGORIES),
        "leader_in_group": lambda: leader_in_group(trades, exclude=TRADE_ALL_CATEGORIES),
        "period_totals": lambda: period_totals(trades),
        "totals_since_import": lambda: totals_since(trades, "Import", since),
        "totals_since_export": lambda: totals_since(trades, "Export", since),
        "balance": balances,
        "balance_leaderboard": lambda: balance_leaderboard(balances(), leaderboard_size),
        "balance_by_period": lambda: balance_by_period(trades),
    }
    for country in countries or ():
        builders[f"balance_by_period:{country}"] = lambda country=country: balance_by_period(trades, country=country)
    return Reports(spark, builders)


def lending_reports(source: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the six reports of one loan feed (already in the common schema)."""
    return {
        "totals": lambda: ranked_totals(source, "country", "original_principal_amount", out="total_loans_amount"),
        "share": lambda: share_of_total(source),
        "mean_rate": lambda: ranked_means(source),
        "profile": lambda: group_profile(source),
        "open_share": lambda: open_share_of_total(source),
        "open_position": cache(lambda: open_position(source)),
    }


def loan_reports(
    spark: SparkSession,
    loans_csv: str,
    credits_csv: str,
    out_dir: str,
    as_of,
    loans_schema=None,
    credits_schema=None,
) -> Reports:
    """Loan and credit feeds: headers normalised, credits harmonised to the loan schema, six
    reports per feed (``loans:*``, ``credits:*``) and the blended rate across both."""
    base = out_dir.rstrip("/")
    loans = materialize_parquet(spark, loans_csv, f"{base}/loans", normalize=True, schema=loans_schema)
    credits = harmonize_columns(materialize_parquet(spark, credits_csv, f"{base}/credits", normalize=True, schema=credits_schema))
    builders = {f"loans:{k}": v for k, v in lending_reports(loans).items()}
    builders |= {f"credits:{k}": v for k, v in lending_reports(credits).items()}
    builders["blended_rate"] = lambda: blended_rate(builders["loans:open_position"](), builders["credits:open_position"](), as_of)
    return Reports(spark, builders)


def duplicate_reports(
    spark: SparkSession,
    csv_path: str,
    columns: Iterable[str],
    out_dir: str | None = None,
    schema=None,
    hash_prefilter: bool = False,
) -> Reports:
    """Duplicate checks of an extract: one report per column, plus all columns in one pass.
    ``hash_prefilter`` is for wide text columns, as in ``duplicate_keys``."""
    columns = list(columns)
    extract = materialize_parquet(spark, csv_path, out_dir, schema=schema) if out_dir else read_csv(spark, csv_path, schema=schema)
    builders = {c: lambda c=c: duplicate_keys(extract, c, hash_prefilter=hash_prefilter) for c in columns}
    builders["all_columns"] = lambda: duplicate_values(extract, columns)
    return Reports(spark, builders)


def market_reports(
    spark: SparkSession,
    input_dir: str,
    manufacturer: str,
    min_capacity: float = 2,
    tables: Mapping[str, str] = MARKET_TABLES,
    types: Mapping[str, Mapping[str, str]] = MARKET_TYPES,
) -> Reports:
    """Rates against prices from a folder of CSV tables (all text, copied once as Parquet and
    cast at ingest). The basket, the per-day table and the product-day means are built once for
    all reports that use them."""
    raw = load_tables(spark, input_dir)
    t = {role: cast_columns(raw[stem], types.get(stem, {})) for role, stem in tables.items()}

    @cache
    def basket() -> DataFrame:
        return daily_basket(t["rates"], t["coins"], sort=False)

    @cache
    def daily() -> DailyPrices:
        return DailyPrices.of(t["prices"], t["products"], basket(), min_capacity=min_capacity)

    @cache
    def peers() -> DataFrame:
        return daily().peer_mean(manufacturer)

    return Reports(
        spark,
        {
            "daily_basket": lambda: basket().orderBy(*total_order(basket(), "TimeId")),
            "enrich_facts": lambda: enrich_facts(t["prices"], t["products"], min_capacity=min_capacity),
            "attach_daily_map": lambda: daily().attached(),
            "peer_mean": peers,
            "period_comparison": lambda: period_comparison(peers(), t["days"]),
        },
    )


def process_monitor(
    spark: SparkSession,
    input_path: str,
    output_path: str | None,
    checkpoint_path: str,
    measures: Iterable[str] = ("memory_percent",),
    processing_time: str | None = "10 seconds",
    mode: str = "complete",
    max_age_seconds: float | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the running per-process totals over snapshot files as a long-running query.

    ``mode`` is ``complete`` (each micro-batch publishes a new version of the result, for
    ``read_version``), ``update`` (a compacted log of changes, for ``read_totals``) or ``console``
    (each micro-batch prints the result; no output path). State and offsets live in
    ``checkpoint_path`` (put it in the shared checkpoint folder), so a restart resumes.
    ``max_age_seconds`` leaves out snapshots that are older when their batch runs; ``clean_source``
    (``"archive"`` or ``"delete"``) retires files once they are read. ``processing_time=None``
    processes what is there and stops (``availableNow``).
    """
    snapshots = snapshot_stream(
        spark, input_path, max_files_per_trigger=max_files_per_trigger, clean_source=clean_source, archive_dir=archive_dir
    )
    if max_age_seconds is not None:
        snapshots = fresh_snapshots(snapshots, None, max_age_seconds)
    totals = running_totals(snapshots, measures=tuple(measures), sort=False)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return start_totals(totals, output_path, checkpoint_path, mode, trigger=trigger, state_partitions=state_partitions)


__all__ = [
    "MARKET_TABLES",
    "MARKET_TYPES",
    "Reports",
    "duplicate_reports",
    "lending_reports",
    "loan_reports",
    "market_reports",
    "process_monitor",
    "trade_reports",
]
