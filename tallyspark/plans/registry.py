"""Registered queries: every operator of the library run over whole derived tables, each with
an equivalent DuckDB SQL text (the correctness oracle).

Query callables take ``(spark, sf_dir)`` and return a DataFrame. Oracle texts read the
pre-registered views (``lineitem``, ``orders``, ...) and rebuild the stand-in tables as CTEs.
Sums and means of prices are exact in both engines (``EXACT_SUM``). Other double means, which
DuckDB adds in some order, are rounded to 4 places in both (``R4``), with DuckDB's rounding
written to match Spark's (``RS``); everything else is compared as computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.binned import exact_totals
from tallyspark.functions.dates import epoch_seconds
from tallyspark.functions.labels import magnitude_label, magnitude_label_sql
from tallyspark.operators import (
    DailyPrices,
    balance,
    balance_by_period,
    balance_from_totals,
    balance_leaderboard,
    blended_rate,
    clean_rows,
    daily_basket,
    distinct_values,
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
from tallyspark.plans.fixtures import fixture, oracle_ctes, typed_fixture
from tallyspark.scratch import new_folder, session_scratch
from tallyspark.sources.files import load_tables, materialize_parquet, normalize_columns, read_csv
from tallyspark.sources.testdata import read_table
from tallyspark.streaming.snapshots import (
    by_total,
    fresh_snapshots,
    run_append,
    run_complete,
    run_update,
    running_totals,
    snapshot_stream,
    write_snapshot_files,
)

# Query parameters for the stand-in data (its years run 1995-2001).
SINCE_YEAR = 1998
AS_OF_DATE = "2000-01-01"
MANUFACTURER = "Brand#1"
LEADERBOARD_SIZE = 200
ONE_COUNTRY = "NATION_ba"
# Snapshot replay of ``events``: one snapshot per 6 days from 2024-01-01 00:00:00 UTC; the
# freshness check runs 300 s after the last snapshot, so exactly that one is fresh.
SNAPSHOT_ORIGIN_EPOCH = 1_704_067_200
SNAPSHOT_INTERVAL_SECONDS = 6 * 86_400
FRESH_AS_OF_EPOCH = SNAPSHOT_ORIGIN_EPOCH + 4 * SNAPSHOT_INTERVAL_SECONDS + 300

CLOSED_SQL = "('Fully Repaid', 'Fully Cancelled')"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def wrap(fn):
        REGISTRY[name] = Query(name, fn, oracle)
        return fn

    return wrap


def L(expr: str) -> str:
    return magnitude_label_sql(expr)


def RS(expr: str, digits: int) -> str:
    """Spark's ``round`` of a double in DuckDB text: Spark rounds the shortest decimal form of
    the double HALF_UP (76299.21065 -> 76299.2107), DuckDB's ``round`` the binary value."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


_BITS_BELOW = 2**44


def EXACT_SUM(expr: str, over: str = "") -> str:
    """The exact sum of doubles in DuckDB text, for values of 512 or more (all their bits are
    multiples of 2**-44) or zero: a sum of integers, rounded once."""
    return f"CAST(sum(CAST(({expr}) * {_BITS_BELOW} AS HUGEINT)) {over} AS DOUBLE) / {_BITS_BELOW}"


def EXACT_MEAN(expr: str, over: str = "") -> str:
    return f"{EXACT_SUM(expr, over)} / count({expr}) {over}"


def R4(expr: str, alias: str) -> str:
    return f"{RS(expr, 4)} AS {alias}"


def round4(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})


def sql(fixtures, body: str, extra=()) -> str:
    """Oracle text: fixture CTEs, then extra ``(name, sql)`` CTEs, then ``body``."""
    head = oracle_ctes(fixtures) if fixtures else ""
    extra_sql = ",\n".join(f"{n} AS ({q})" for n, q in extra)
    if extra_sql:
        head = (head.rstrip() + ",\n" if head else "WITH ") + extra_sql + "\n"
    return head + body


def _data_key(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:16]


# --------------------------------------------------------------------------- trade
TRADE_CLEAN = ("trade_clean", "SELECT * FROM trade WHERE NOT regexp_matches(country_or_area, '[0-9]') AND flow IS NOT NULL")


def trade(spark, sf):
    return fixture(spark, sf, "trade")


def trade_clean(spark, sf):
    return clean_rows(trade(spark, sf))


@register("clean_rows", sql(["trade"], "SELECT * FROM trade_clean", [TRADE_CLEAN]))
def q_clean_rows(spark, sf):
    return trade_clean(spark, sf)


@register(
    "clean_rows_documents",
    "SELECT * FROM documents WHERE NOT regexp_matches(text, '[0-9]')",
)
def q_clean_rows_documents(spark, sf):
    return clean_rows(read_table(spark, sf, "documents"), text_column="text", required=())


@register(
    "magnitude_label",
    sql(
        ["trade"],
        f"SELECT *, {L('trade_usd')} AS trade_usd_str, {L('-trade_usd')} AS negated_str, "
        f"{L('trade_usd * 1000')} AS thousandfold_str FROM trade",
    ),
)
def q_magnitude_label(spark, sf):
    t = trade(spark, sf)
    return t.withColumns(
        {
            "trade_usd_str": magnitude_label("trade_usd"),
            "negated_str": magnitude_label(-F.col("trade_usd")),
            "thousandfold_str": magnitude_label(F.col("trade_usd") * 1000),
        }
    )


@register(
    "top_with_ties",
    sql(
        ["trade"],
        f"""SELECT country_or_area, year, comm_code, commodity, category, flow, trade_usd, {L('trade_usd')} AS biggest_trade
FROM (SELECT *, max(trade_usd) OVER (PARTITION BY country_or_area, flow) AS mx FROM trade_clean WHERE comm_code <> 'TOTAL')
WHERE trade_usd = mx""",
        [TRADE_CLEAN],
    ),
)
def q_top_with_ties(spark, sf):
    return top_with_ties(trade_clean(spark, sf), exclude={"comm_code": "TOTAL"})


@register(
    "ranked_totals_commodity",
    sql(
        ["trade"],
        f"SELECT commodity, flow, {L('CAST(sum(trade_usd) AS BIGINT)')} AS overall_sum FROM trade_clean "
        "WHERE commodity <> 'ALL COMMODITIES' GROUP BY commodity, flow",
        [TRADE_CLEAN],
    ),
)
def q_ranked_totals_commodity(spark, sf):
    return ranked_totals(
        trade_clean(spark, sf), ["commodity", "flow"], "trade_usd", exclude={"commodity": "ALL COMMODITIES"}, label=True
    )


@register(
    "ranked_totals_category",
    sql(
        ["trade"],
        f"SELECT category, flow, {L('CAST(sum(trade_usd) AS BIGINT)')} AS overall_sum FROM trade_clean "
        "WHERE category <> 'all_commodities' GROUP BY category, flow",
        [TRADE_CLEAN],
    ),
)
def q_ranked_totals_category(spark, sf):
    return ranked_totals(
        trade_clean(spark, sf), ["category", "flow"], "trade_usd", exclude={"category": "all_commodities"}, label=True
    )


@register(
    "leader_in_group",
    sql(
        ["trade"],
        f"""SELECT commodity, flow, category, {L('overall_sum')} AS overall_sum, {L('sum_for_good')} AS sum_for_good
FROM (SELECT *, max(sum_for_good) OVER (PARTITION BY category, flow) AS top FROM per_item)
WHERE sum_for_good = top""",
        [
            TRADE_CLEAN,
            (
                "per_item",
                "SELECT commodity, category, flow, CAST(sum(trade_usd) AS BIGINT) AS sum_for_good, "
                "CAST(sum(sum(trade_usd)) OVER (PARTITION BY category, flow) AS BIGINT) AS overall_sum "
                "FROM trade_clean WHERE category <> 'all_commodities' GROUP BY commodity, category, flow",
            ),
        ],
    ),
)
def q_leader_in_group(spark, sf):
    return leader_in_group(trade_clean(spark, sf), exclude={"category": "all_commodities"})


@register(
    "period_totals",
    sql(
        ["trade"],
        f"""SELECT country_or_area, flow, year, overall_sum, {L('overall_sum')} AS overall_sum_str
FROM (SELECT country_or_area, flow, year, CAST(sum(trade_usd) AS BIGINT) AS overall_sum FROM trade_clean GROUP BY 1, 2, 3)""",
        [TRADE_CLEAN],
    ),
)
def q_period_totals(spark, sf):
    return period_totals(trade_clean(spark, sf))


def _totals_since_sql(flow: str) -> str:
    return (
        f"SELECT country_or_area, flow, CAST(sum(trade_usd) AS BIGINT) AS overall_sum FROM trade_clean "
        f"WHERE TRY_CAST(year AS INTEGER) >= {SINCE_YEAR} AND flow = '{flow}' GROUP BY country_or_area, flow"
    )


@register(
    "totals_since_import",
    sql(
        ["trade"],
        f"SELECT *, {L('overall_sum')} AS overall_sum_str FROM t",
        [TRADE_CLEAN, ("t", _totals_since_sql("Import"))],
    ),
)
def q_totals_since_import(spark, sf):
    return totals_since(trade_clean(spark, sf), "Import", SINCE_YEAR)


@register(
    "totals_since_export",
    sql(
        ["trade"],
        f"SELECT *, {L('overall_sum')} AS overall_sum_str FROM t",
        [TRADE_CLEAN, ("t", _totals_since_sql("Export"))],
    ),
)
def q_totals_since_export(spark, sf):
    return totals_since(trade_clean(spark, sf), "Export", SINCE_YEAR)


_BALANCE_CTES = [
    TRADE_CLEAN,
    ("ex", _totals_since_sql("Export")),
    ("im", _totals_since_sql("Import")),
    (
        "bal",
        "SELECT ex.country_or_area, ex.overall_sum AS overall_export, im.overall_sum AS overall_import, "
        "ex.overall_sum - im.overall_sum AS saldo FROM ex JOIN im ON ex.country_or_area = im.country_or_area",
    ),
]


@register("balance", sql(["trade"], f"SELECT *, {L('saldo')} AS saldo_str FROM bal", _BALANCE_CTES))
def q_balance(spark, sf):
    return balance(trade_clean(spark, sf), SINCE_YEAR)


@register("balance_join_form", sql(["trade"], f"SELECT *, {L('saldo')} AS saldo_str FROM bal", _BALANCE_CTES))
def q_balance_join_form(spark, sf):
    t = trade_clean(spark, sf)
    return balance_from_totals(totals_since(t, "Export", SINCE_YEAR), totals_since(t, "Import", SINCE_YEAR))


@register(
    "balance_leaderboard",
    sql(
        ["trade"],
        f"SELECT *, {L('saldo')} AS saldo_str FROM bal ORDER BY saldo DESC NULLS LAST, country_or_area LIMIT {LEADERBOARD_SIZE}",
        _BALANCE_CTES,
    ),
)
def q_balance_leaderboard(spark, sf):
    return balance_leaderboard(balance(trade_clean(spark, sf), SINCE_YEAR), LEADERBOARD_SIZE)


@register(
    "balance_by_period",
    sql(
        ["trade"],
        f"""SELECT country_or_area, year, export_total, import_total, export_total - import_total AS saldo,
{L('export_total - import_total')} AS saldo_str
FROM (SELECT country_or_area, year, flow, CAST(sum(trade_usd) AS BIGINT) AS export_total,
             lead(CAST(sum(trade_usd) AS BIGINT)) OVER (PARTITION BY country_or_area, year ORDER BY flow) AS import_total
      FROM trade_clean WHERE flow IN ('Import', 'Export') GROUP BY country_or_area, year, flow)
WHERE export_total - import_total IS NOT NULL""",
        [TRADE_CLEAN],
    ),
)
def q_balance_by_period(spark, sf):
    return balance_by_period(trade_clean(spark, sf))


@register(
    "balance_by_period_country",
    sql(
        ["trade"],
        f"""SELECT country_or_area, year, export_total, import_total, export_total - import_total AS saldo,
{L('export_total - import_total')} AS saldo_str
FROM (SELECT country_or_area, year, flow, CAST(sum(trade_usd) AS BIGINT) AS export_total,
             lead(CAST(sum(trade_usd) AS BIGINT)) OVER (PARTITION BY country_or_area, year ORDER BY flow) AS import_total
      FROM trade_clean WHERE country_or_area = '{ONE_COUNTRY}' AND flow IN ('Import', 'Export') GROUP BY country_or_area, year, flow)
WHERE export_total - import_total IS NOT NULL""",
        [TRADE_CLEAN],
    ),
)
def q_balance_by_period_country(spark, sf):
    return balance_by_period(trade_clean(spark, sf), country=ONE_COUNTRY)


# --------------------------------------------------------------------------- loans
def loans(spark, sf):
    return fixture(spark, sf, "loans_ibrd")


def credits_harmonized(spark, sf):
    return harmonize_columns(fixture(spark, sf, "credits_ida"))


CREDITS_H = (
    "credits_h",
    "SELECT country, original_principal_amount, service_charge_rate AS interest_rate, credit_status AS loan_status, "
    "last_repayment_date FROM credits_ida",
)


@register(
    "loan_totals",
    sql(["loans_ibrd"], "SELECT country, CAST(sum(original_principal_amount) AS BIGINT) AS total_loans_amount FROM loans_ibrd GROUP BY country"),
)
def q_loan_totals(spark, sf):
    return ranked_totals(loans(spark, sf), "country", "original_principal_amount", out="total_loans_amount")


def _share_sql(source: str, where: str = "") -> str:
    return f"""SELECT country, total_loans_amount, total_loans_worldwide,
total_loans_amount / nullif(total_loans_worldwide, 0) * 100 AS percenteage_from_worldwide
FROM (SELECT country, total_loans_amount, CAST(sum(total_loans_amount) OVER () AS BIGINT) AS total_loans_worldwide
      FROM (SELECT country, CAST(sum(original_principal_amount) AS BIGINT) AS total_loans_amount FROM {source} {where} GROUP BY country))"""


@register("loan_share", sql(["loans_ibrd"], _share_sql("loans_ibrd")))
def q_loan_share(spark, sf):
    return share_of_total(loans(spark, sf))


@register(
    "loan_mean_rate",
    sql(["loans_ibrd"], f"SELECT country, {R4('avg(interest_rate)', 'avg_interest_rate')} FROM loans_ibrd GROUP BY country"),
)
def q_loan_mean_rate(spark, sf):
    return round4(ranked_means(loans(spark, sf)), "avg_interest_rate")


@register(
    "loan_profile",
    sql(
        ["loans_ibrd"],
        f"SELECT country, count(country) AS number_of_loans, {R4('avg(interest_rate)', 'avg_interest_rate')}, "
        "CAST(sum(original_principal_amount) AS BIGINT) AS total_loans_amount FROM loans_ibrd GROUP BY country",
    ),
)
def q_loan_profile(spark, sf):
    return round4(group_profile(loans(spark, sf)), "avg_interest_rate")


@register("open_loan_share", sql(["loans_ibrd"], _share_sql("loans_ibrd", f"WHERE loan_status NOT IN {CLOSED_SQL}")))
def q_open_loan_share(spark, sf):
    return open_share_of_total(loans(spark, sf))


def _open_position_sql(source: str, rate_expr: str) -> str:
    return (
        f"SELECT country, CAST(sum(original_principal_amount) AS BIGINT) AS total_loans_amount, {rate_expr} AS avg_interest_rate, "
        "max(CAST(try_strptime(last_repayment_date, '%m/%d/%Y %H:%M:%S') AS DATE)) AS due_date "
        f"FROM {source} WHERE loan_status NOT IN {CLOSED_SQL} GROUP BY country"
    )


@register("open_position", sql(["loans_ibrd"], _open_position_sql("loans_ibrd", RS("avg(interest_rate)", 4))))
def q_open_position(spark, sf):
    return round4(open_position(loans(spark, sf)), "avg_interest_rate")


@register(
    "blended_rate",
    sql(
        ["loans_ibrd", "credits_ida"],
        f"""SELECT country, ibrd_loans, ibrd_interest_rate, ida_loans, ida_interest_rate, ibrd_loans + ida_loans AS total_loans_amount,
{RS('ibrd_interest_rate * ibrd_part / nullif(ibrd_part + ida_part, 0) + ida_interest_rate * ida_part / nullif(ibrd_part + ida_part, 0)', 3)} AS avg_interest_rate
FROM (SELECT *, date_diff('day', DATE '{AS_OF_DATE}', ibrd_due_date) * ibrd_interest_rate * ibrd_loans AS ibrd_part,
             date_diff('day', DATE '{AS_OF_DATE}', ida_due_date) * ida_interest_rate * ida_loans AS ida_part
      FROM (SELECT a.country, a.total_loans_amount AS ibrd_loans, {RS('a.avg_interest_rate', 3)} AS ibrd_interest_rate, a.due_date AS ibrd_due_date,
                   b.total_loans_amount AS ida_loans, {RS('b.avg_interest_rate', 3)} AS ida_interest_rate, b.due_date AS ida_due_date
            FROM pos_a a JOIN pos_b b ON a.country = b.country))""",
        [
            CREDITS_H,
            ("pos_a", _open_position_sql("loans_ibrd", "avg(interest_rate)")),
            ("pos_b", _open_position_sql("credits_h", "avg(interest_rate)")),
        ],
    ),
)
def q_blended_rate(spark, sf):
    return blended_rate(open_position(loans(spark, sf)), open_position(credits_harmonized(spark, sf)), AS_OF_DATE)


@register(
    "credit_totals",
    sql(
        ["credits_ida"],
        "SELECT country, CAST(sum(original_principal_amount) AS BIGINT) AS total_loans_amount FROM credits_h GROUP BY country",
        [CREDITS_H],
    ),
)
def q_credit_totals(spark, sf):
    return ranked_totals(credits_harmonized(spark, sf), "country", "original_principal_amount", out="total_loans_amount")


@register("credit_share", sql(["credits_ida"], _share_sql("credits_h"), [CREDITS_H]))
def q_credit_share(spark, sf):
    return share_of_total(credits_harmonized(spark, sf))


@register(
    "credit_mean_rate",
    sql(["credits_ida"], f"SELECT country, {R4('avg(interest_rate)', 'avg_interest_rate')} FROM credits_h GROUP BY country", [CREDITS_H]),
)
def q_credit_mean_rate(spark, sf):
    return round4(ranked_means(credits_harmonized(spark, sf)), "avg_interest_rate")


@register(
    "credit_profile",
    sql(
        ["credits_ida"],
        f"SELECT country, count(country) AS number_of_loans, {R4('avg(interest_rate)', 'avg_interest_rate')}, "
        "CAST(sum(original_principal_amount) AS BIGINT) AS total_loans_amount FROM credits_h GROUP BY country",
        [CREDITS_H],
    ),
)
def q_credit_profile(spark, sf):
    return round4(group_profile(credits_harmonized(spark, sf)), "avg_interest_rate")


@register(
    "open_credit_share",
    sql(["credits_ida"], _share_sql("credits_h", f"WHERE loan_status NOT IN {CLOSED_SQL}"), [CREDITS_H]),
)
def q_open_credit_share(spark, sf):
    return open_share_of_total(credits_harmonized(spark, sf))


@register(
    "credit_open_position",
    sql(["credits_ida"], _open_position_sql("credits_h", RS("avg(interest_rate)", 4)), [CREDITS_H]),
)
def q_credit_open_position(spark, sf):
    return round4(open_position(credits_harmonized(spark, sf)), "avg_interest_rate")


@register("harmonize_columns", sql(["credits_ida"], "SELECT * FROM credits_h", [CREDITS_H]))
def q_harmonize_columns(spark, sf):
    return credits_harmonized(spark, sf)


# --------------------------------------------------------------------------- exact sums
#: The scale of the amounts of ``cancelling_totals``: exact powers of two, 120 orders of magnitude apart.
_HUGE, _TINY = 2.0**200, 2.0**-200


def cancelling_amounts(spark, sf) -> DataFrame:
    """Postings whose huge amounts cancel: each line item is booked, reversed, and leaves a tiny rest."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("double")
    items = read_table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", cents.alias("cents"))
    amounts = F.array(F.col("cents") * _HUGE, F.col("cents") * _TINY, -F.col("cents") * _HUGE)
    return items.select("l_returnflag", "l_linestatus", F.explode(amounts).alias("amount"))


@register(
    "cancelling_totals",
    f"SELECT l_returnflag, l_linestatus, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) * {_TINY!r} AS total, "
    f"CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (3 * count(*)) * {_TINY!r} AS mean, 3 * count(*) AS postings "
    "FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def q_cancelling_totals(spark, sf):
    """Exact sums and means of values 120 orders of magnitude apart."""
    return exact_totals(
        cancelling_amounts(spark, sf),
        ["l_returnflag", "l_linestatus"],
        sums={"total": "amount"},
        means={"mean": "amount"},
        counts={"postings": "amount"},
    )


# --------------------------------------------------------------------------- data quality
@register(
    "duplicate_keys",
    "SELECT text, count(*) AS number_of_occurrences FROM documents GROUP BY text HAVING count(*) > 1",
)
def q_duplicate_keys(spark, sf):
    return duplicate_keys(read_table(spark, sf, "documents"), "text")


@register(
    "duplicate_texts_prefiltered",
    "SELECT text, count(*) AS number_of_occurrences FROM documents GROUP BY text HAVING count(*) > 1",
)
def q_duplicate_texts_prefiltered(spark, sf):
    return duplicate_keys(read_table(spark, sf, "documents"), "text", hash_prefilter=True)


@register(
    "duplicate_keys_lineitem",
    "SELECT l_orderkey, l_linenumber, count(*) AS number_of_occurrences FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def q_duplicate_keys_lineitem(spark, sf):
    return duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


CUSTOMER_CHECK_COLUMNS = ("c_name", "c_nationkey", "c_mktsegment")


@register(
    "duplicate_values_customer",
    "SELECT column_name, value, count(*) AS number_of_occurrences FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM customer" for c in CUSTOMER_CHECK_COLUMNS)
    + ") GROUP BY column_name, value HAVING count(*) > 1",
)
def q_duplicate_values_customer(spark, sf):
    return duplicate_values(read_table(spark, sf, "customer"), CUSTOMER_CHECK_COLUMNS)


@register("distinct_values", "SELECT DISTINCT p_type FROM part")
def q_distinct_values(spark, sf):
    return distinct_values(read_table(spark, sf, "part"), "p_type")


# --------------------------------------------------------------------------- market
def basket(spark, sf, sort=True):
    return daily_basket(typed_fixture(spark, sf, "crypto_rate"), typed_fixture(spark, sf, "crypto_dim"), sort=sort)


def enriched(spark, sf):
    return enrich_facts(typed_fixture(spark, sf, "gpu_price"), typed_fixture(spark, sf, "gpu_dim"))


def daily_prices(spark, sf):
    prices, products = typed_fixture(spark, sf, "gpu_price"), typed_fixture(spark, sf, "gpu_dim")
    return DailyPrices.of(prices, products, basket(spark, sf, sort=False))


def attached(spark, sf):
    return daily_prices(spark, sf).attached()


def nvidia(spark, sf):
    return daily_prices(spark, sf).peer_mean(MANUFACTURER)


_MARKET_FIXTURES = ["crypto_rate_typed", "crypto_dim_typed", "gpu_price_typed", "gpu_dim_typed"]
_BASKET_CTES = [
    (
        "coin_rows",
        "SELECT r.TimeId, r.High, d.Currency_Name, d.Code, (r.Open + r.Close + r.High + r.Low) / 4 AS row_mean "
        "FROM crypto_rate_typed r JOIN crypto_dim_typed d ON r.CodeId = d.Id WHERE d.Is_Mineable = 1",
    ),
    (
        "day_sum",
        "SELECT TimeId, count(Code) AS Number_Of_Mineable_Coins, "
        f"{EXACT_SUM('row_mean')} AS Avg_Crypto_Rate "
        "FROM coin_rows GROUP BY TimeId",
    ),
    (
        "basket",
        "SELECT c.TimeId, c.High, c.Currency_Name, d.Number_Of_Mineable_Coins, d.Avg_Crypto_Rate "
        "FROM coin_rows c JOIN day_sum d ON c.TimeId IS NOT DISTINCT FROM d.TimeId",
    ),
]
_ENRICH_CTE = (
    "enriched",
    "SELECT p.*, g.Processor_Manufacturer, g.Processor, g.GPU_Manufacturer, g.Memory_Capacity "
    "FROM gpu_price_typed p JOIN gpu_dim_typed g ON p.ProdId = g.Id WHERE g.Memory_Capacity >= 2",
)
_ATTACH_CTES = [
    *_BASKET_CTES,
    _ENRICH_CTE,
    (
        "per_day",
        "SELECT TimeId, max(Number_Of_Mineable_Coins) AS Number_Of_Mineable_Coins, max(Avg_Crypto_Rate) AS Avg_Crypto_Rate, "
        "CAST(to_json(list(map([Currency_Name], [High]) ORDER BY Currency_Name)) AS VARCHAR) AS Coin_Map FROM "
        "(SELECT TimeId, Currency_Name, max(High) AS High, max(Number_Of_Mineable_Coins) AS Number_Of_Mineable_Coins, "
        "max(Avg_Crypto_Rate) AS Avg_Crypto_Rate FROM basket GROUP BY TimeId, Currency_Name) GROUP BY TimeId",
    ),
    ("attached", "SELECT e.*, d.Number_Of_Mineable_Coins, d.Avg_Crypto_Rate, d.Coin_Map FROM (SELECT DISTINCT * FROM enriched) e JOIN per_day d ON e.TimeId = d.TimeId"),
]
_PEER_CTE = (
    "peer",
    f"SELECT ProdId, TimeId, {EXACT_MEAN('Price_USD')} AS Price_USD, "
    f"{EXACT_MEAN('Price_Original')} AS Price_Original, Processor_Manufacturer, Processor, "
    "GPU_Manufacturer, Memory_Capacity, Number_Of_Mineable_Coins, Avg_Crypto_Rate, Coin_Map FROM attached "
    f"WHERE Processor_Manufacturer = '{MANUFACTURER}' GROUP BY ProdId, TimeId, Processor_Manufacturer, Processor, GPU_Manufacturer, "
    "Memory_Capacity, Number_Of_Mineable_Coins, Avg_Crypto_Rate, Coin_Map",
)


@register(
    "daily_basket",
    sql(
        _MARKET_FIXTURES[:2],
        f"SELECT TimeId, High, Currency_Name, Number_Of_Mineable_Coins, {R4('Avg_Crypto_Rate', 'Avg_Crypto_Rate')} FROM basket",
        _BASKET_CTES,
    ),
)
def q_daily_basket(spark, sf):
    return round4(basket(spark, sf), "Avg_Crypto_Rate")


@register("enrich_facts", sql(_MARKET_FIXTURES[2:], "SELECT * FROM enriched", [_ENRICH_CTE]))
def q_enrich_facts(spark, sf):
    return enriched(spark, sf)


@register(
    "attach_daily_map",
    sql(_MARKET_FIXTURES, f"SELECT * REPLACE ({R4('Avg_Crypto_Rate', 'Avg_Crypto_Rate')}) FROM attached", _ATTACH_CTES),
)
def q_attach_daily_map(spark, sf):
    return round4(attached(spark, sf), "Avg_Crypto_Rate")


@register(
    "peer_mean",
    sql(
        _MARKET_FIXTURES,
        f"SELECT * REPLACE ({R4('Price_USD', 'Price_USD')}, {R4('Price_Original', 'Price_Original')}, "
        f"{R4('Avg_Crypto_Rate', 'Avg_Crypto_Rate')}) FROM peer",
        [*_ATTACH_CTES, _PEER_CTE],
    ),
)
def q_peer_mean(spark, sf):
    return round4(nvidia(spark, sf), "Price_USD", "Price_Original", "Avg_Crypto_Rate")


@register(
    "period_comparison",
    sql(
        [*_MARKET_FIXTURES, "time_dim_typed"],
        f"""SELECT TimeId, Processor_Manufacturer AS CPU_Producer, Processor, {RS('Memory_Capacity', 0)} AS GB,
GPU_Manufacturer AS GPU_Producer, Number_Of_Mineable_Coins, {RS('Avg_Crypto_Rate', 2)} AS Daily_Avg_Crypto_Rate,
{RS(EXACT_MEAN('Avg_Crypto_Rate', 'OVER (PARTITION BY Year)'), 2)} AS Year_Avg_Crypto_Rate, {RS('Price_USD', 2)} AS Price_USD,
{RS('Price_Original', 2)} AS Price_Original, {RS(EXACT_MEAN('Price_USD', 'OVER (PARTITION BY ProdId, Year)'), 2)} AS Avg_Price_USD
FROM peer p JOIN time_dim_typed t ON p.TimeId = t.Id""",
        [*_ATTACH_CTES, _PEER_CTE],
    ),
)
def q_period_comparison(spark, sf):
    return period_comparison(nvidia(spark, sf), typed_fixture(spark, sf, "time_dim"))


# --------------------------------------------------------------------------- ingest
# Display headers for the CSV copy of ``part`` (normalised back by ``normalize_columns``).
PART_HEADERS = {
    "p_partkey": "Part Key",
    "p_name": "Part Name",
    "p_brand": "Brand",
    "p_type": "Type",
    "p_size": "Size (cm)",
    "p_retailprice": "Retail Price (US$)",
}


def _written_once(spark, sf, label: str, write) -> str:
    """A stand-in feed, written by ``write(folder)`` at its first use in a session and owned by it."""
    key = (spark.sparkContext.applicationId, _data_key(sf), label)
    if key not in _FEEDS:
        with session_scratch(spark).building():
            folder = new_folder(spark, "feeds", label.replace("/", "-"))
        write(folder)
        _FEEDS[key] = folder
    return _FEEDS[key]


_FEEDS: dict[tuple[str, str, str], str] = {}


def _csv_copy(spark, sf, table: str, headers=None) -> str:
    """``table`` as a header CSV folder."""

    def write(folder):
        df = read_table(spark, sf, table)
        (df.withColumnsRenamed(headers) if headers else df).write.option("header", "true").csv(folder)

    return _written_once(spark, sf, f"{table}-display" if headers else table, write)


@register("read_csv", "SELECT * FROM nation")
def q_read_csv(spark, sf):
    return read_csv(spark, _csv_copy(spark, sf, "nation"))


@register("materialize_parquet", "SELECT * FROM nation")
def q_materialize_parquet(spark, sf):
    return materialize_parquet(spark, _csv_copy(spark, sf, "nation"), new_folder(spark, "runs", "nation"))


@register(
    "normalize_columns",
    'SELECT CAST(p_partkey AS INTEGER) AS part_key, p_name AS part_name, p_brand AS brand, p_type AS "type", '
    'p_size AS size_cm, p_retailprice AS "retail_price_us$" FROM part',
)
def q_normalize_columns(spark, sf):
    return normalize_columns(read_csv(spark, _csv_copy(spark, sf, "part", PART_HEADERS)))


@register(
    "load_tables",
    "SELECT 'nation' AS table_name, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CAST(n_regionkey AS VARCHAR) AS detail FROM nation "
    "UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name, CAST(p_size AS VARCHAR) FROM part",
)
def q_load_tables(spark, sf):
    """Rows of both tables of the folder, all text."""

    def write(folder):
        for table in ("nation", "part"):
            read_table(spark, sf, table).write.option("header", "true").csv(f"{folder}/{table}.csv")

    tables = load_tables(spark, _written_once(spark, sf, "folder", write))
    shown = {"nation": ("n_nationkey", "n_name", "n_regionkey"), "part": ("p_partkey", "p_name", "p_size")}
    parts = [
        tables[t].select(F.lit(t).alias("table_name"), *[F.col(c).alias(out) for c, out in zip(columns, ("key", "name", "detail"), strict=True)])
        for t, columns in shown.items()
    ]
    return parts[0].unionByName(parts[1])


# --------------------------------------------------------------------------- streaming
_SNAPSHOT_EPOCH_SQL = (
    f"CAST({SNAPSHOT_ORIGIN_EPOCH} + floor((epoch(ts) - {SNAPSHOT_ORIGIN_EPOCH}) / {SNAPSHOT_INTERVAL_SECONDS}) "
    f"* {SNAPSHOT_INTERVAL_SECONDS} AS BIGINT)"
)
_SNAPSHOT_CTE = (
    "snap",
    "SELECT CAST(user_id AS VARCHAR) AS pid, event_type AS name, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS cpu_percent, "
    f"value AS memory_percent, {_SNAPSHOT_EPOCH_SQL} AS snapshot_epoch FROM events",
)


def snapshot_files(spark, sf) -> str:
    """``events`` replayed as snapshot CSV folders ``sys_log=<epoch>/`` (written once a session)."""

    def write(folder):
        ev = read_table(spark, sf, "events")
        bucket = F.floor((epoch_seconds("ts") - F.lit(SNAPSHOT_ORIGIN_EPOCH)) / F.lit(SNAPSHOT_INTERVAL_SECONDS))
        snaps = ev.select(
            F.col("user_id").cast("string").alias("pid"),
            F.col("event_type").alias("name"),
            F.get_json_object("props", "$.k").cast("double").alias("cpu_percent"),
            F.col("value").alias("memory_percent"),
            (F.lit(SNAPSHOT_ORIGIN_EPOCH) + bucket * F.lit(SNAPSHOT_INTERVAL_SECONDS)).cast("long").alias("snapshot_epoch"),
        )
        write_snapshot_files(snaps, folder)

    return _written_once(spark, sf, "snapshots", write) + "/sys_log=*/*.csv"


def _run_dirs(spark) -> tuple[str, str]:
    run = new_folder(spark, "runs", "stream")
    return run + "/out", run + "/checkpoint"


@register(
    "running_totals",
    sql(None, f"SELECT name, {R4('sum(memory_percent)', 'total_memory_percent')} FROM snap GROUP BY name", [_SNAPSHOT_CTE]),
)
def q_running_totals(spark, sf):
    out, ckpt = _run_dirs(spark)
    stream = snapshot_stream(spark, snapshot_files(spark, sf), max_files_per_trigger=1)
    totals = run_complete(running_totals(stream, sort=False), out, ckpt)
    return round4(by_total(totals), "total_memory_percent")


@register(
    "running_totals_update",
    sql(None, f"SELECT name, {R4('sum(memory_percent)', 'total_memory_percent')} FROM snap GROUP BY name", [_SNAPSHOT_CTE]),
)
def q_running_totals_update(spark, sf):
    out, ckpt = _run_dirs(spark)
    stream = snapshot_stream(spark, snapshot_files(spark, sf), max_files_per_trigger=1)
    totals = run_update(running_totals(stream, sort=False), out, ckpt)
    return round4(by_total(totals), "total_memory_percent")


@register(
    "running_totals_cpu",
    sql(
        None,
        f"SELECT name, {R4('sum(memory_percent)', 'total_memory_percent')}, {R4('sum(cpu_percent)', 'total_cpu_percent')} "
        "FROM snap GROUP BY name",
        [_SNAPSHOT_CTE],
    ),
)
def q_running_totals_cpu(spark, sf):
    out, ckpt = _run_dirs(spark)
    stream = snapshot_stream(spark, snapshot_files(spark, sf), max_files_per_trigger=1)
    measures = ("memory_percent", "cpu_percent")
    totals = run_complete(running_totals(stream, measures=measures, sort=False), out, ckpt)
    return round4(by_total(totals, measures), "total_memory_percent", "total_cpu_percent")


@register(
    "fresh_snapshots",
    sql(None, f"SELECT * FROM snap WHERE {FRESH_AS_OF_EPOCH} - snapshot_epoch <= 300", [_SNAPSHOT_CTE]),
)
def q_fresh_snapshots(spark, sf):
    out, ckpt = _run_dirs(spark)
    stream = snapshot_stream(spark, snapshot_files(spark, sf), max_files_per_trigger=1)
    fresh = fresh_snapshots(stream, FRESH_AS_OF_EPOCH).select(
        "pid", "name", "cpu_percent", "memory_percent", F.col("snapshot_epoch").cast("long").alias("snapshot_epoch")
    )
    return run_append(fresh, out, ckpt)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle is not None}
