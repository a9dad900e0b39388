"""Daily coin rates against product prices (G1–G5): a star schema of two facts (rates, prices)
and three dimensions (coins, products, days).

Shapes chosen for scale:
* dimensions are broadcast only after a size check of rows and bytes; beyond it the fact is
  shuffled without its heavy keys (``join_dimension``);
* per-day and per-year figures are small aggregates, written once and broadcast back, never
  windows over raw rows (a window on ``Year`` would put a whole year in one task);
* the rates side is reduced to one row per day *before* it meets the price fact, so the big
  fact is never fanned out by the number of coins;
* prices are cut to the rows that matter by semi-joins, de-duplicated, averaged and sorted on
  their own six columns; product attributes and the day's coin map are joined last, so no
  shuffle carries them (``DailyPrices``).

Sums and means are exact (``exact_totals``): they do not depend on row order or partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.binned import exact_totals
from tallyspark.operators.joins import (
    BROADCAST_MAX_ROWS,
    broadcast_if_small,
    fits_broadcast,
    join_dimension,
    join_on_keys,
    materialize_small,
    settle,
    size_probe,
    stage,
    total_order,
)
from tallyspark.operators.quality import byte_equal, may_be_among

# The OHLC columns whose mean is a coin's daily rate.
OHLC = ("Open", "Close", "High", "Low")

# The columns of a product-day that the period report shows or averages.
COMPARED = (
    "Processor_Manufacturer",
    "Processor",
    "Memory_Capacity",
    "GPU_Manufacturer",
    "Number_Of_Mineable_Coins",
    "Avg_Crypto_Rate",
    "Price_USD",
    "Price_Original",
)


def daily_basket(
    rates: DataFrame,
    coins: DataFrame,
    time: str = "TimeId",
    code_id: str = "CodeId",
    coin_id: str = "Id",
    mineable: str = "Is_Mineable",
    sort: bool = True,
) -> DataFrame:
    """Mineable coins' rates per day. One row per (day, coin) rate row with ``High`` and
    ``Currency_Name``, plus the day's ``Number_Of_Mineable_Coins`` (non-null codes) and
    ``Avg_Crypto_Rate``, the *sum* over the day's rows of each coin's OHLC mean.

    The rates are read once: the rows' few columns are written, and the per-day figures (one
    exact aggregate, written and broadcast back when the day count is bounded) and the result
    read those; no day's rows are gathered in one task. Ordered by day; pass ``sort=False`` when
    the result feeds another aggregate.
    """
    dim = broadcast_if_small(coins.filter(F.col(mineable) == 1).select(coin_id, "Code", "Currency_Name"))
    joined = rates.join(dim, rates[code_id] == dim[coin_id], "inner")
    row_mean = sum((F.col(c) for c in OHLC[1:]), F.col(OHLC[0])) / F.lit(4)
    rows, _ = stage(joined.select(time, "High", "Currency_Name", "Code", row_mean.alias("__row_mean")))
    figures = exact_totals(rows, [time], sums={"Avg_Crypto_Rate": "__row_mean"}, counts={"Number_Of_Mineable_Coins": "Code"})
    per_day = materialize_small(figures.select(time, "Number_Of_Mineable_Coins", "Avg_Crypto_Rate"))
    out = join_on_keys(rows.select(time, "High", "Currency_Name"), per_day, [time])
    return out.orderBy(*total_order(out, time)) if sort else out


def enrich_facts(
    prices: DataFrame,
    products: DataFrame,
    min_capacity: float = 2,
    product_key: str = "ProdId",
    product_id: str = "Id",
    capacity: str = "Memory_Capacity",
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Price facts joined to products with ``capacity >= min_capacity`` (null capacity is
    dropped); the product id column is dropped after the join. Products are broadcast up to
    ``max_rows`` (and 64 MB); beyond, prices are shuffled by product but for heavy products."""
    dim = products.filter(F.col(capacity) >= F.lit(min_capacity))
    return join_dimension(prices, dim, product_key, product_id, max_rows)


def coin_map_per_day(basket: DataFrame, time: str = "TimeId", coin: str = "Currency_Name", value: str = "High") -> DataFrame:
    """One row per day: the day's coin count and rate, and ``Coin_Map``, a JSON list of
    ``{coin: value}`` objects sorted by coin.

    The rates are first reduced to one per day and coin, so the list holds each coin of the
    dimension once however many rates it has that day. Of several rates of a coin on a day the
    highest counts. A coin without a name has no entry, one without a rate an entry with null.
    """
    per_coin = basket.groupBy(time, coin).agg(
        F.max(value).alias(value),
        F.max("Number_Of_Mineable_Coins").alias("Number_Of_Mineable_Coins"),
        F.max("Avg_Crypto_Rate").alias("Avg_Crypto_Rate"),
    )
    entry = F.when(F.col(coin).isNotNull(), F.struct(F.col(coin).alias("k"), F.col(value).alias("v")))
    entries = F.sort_array(F.collect_list(entry))
    return per_coin.groupBy(time).agg(
        F.max("Number_Of_Mineable_Coins").alias("Number_Of_Mineable_Coins"),
        F.max("Avg_Crypto_Rate").alias("Avg_Crypto_Rate"),
        F.to_json(F.transform(entries, lambda e: F.create_map(e["k"], e["v"]))).alias("Coin_Map"),
    )


def attach_daily_map(
    prices: DataFrame,
    basket: DataFrame,
    time: str = "TimeId",
    sort_keys=("ProdId", "TimeId"),
    max_days: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Distinct price rows that have a rate day, each with the day's coin count, rate and
    coin map; ordered by ``sort_keys`` (refined by the other columns, so one hot product-day
    cannot fill a single sort task; pass ``()`` to skip the global sort).

    For rows of any columns; where the rows are prices joined to products, ``DailyPrices`` gives
    the same result without shuffling the products' columns. The per-day table (one row per day) is
    written once and broadcast after a bounded count; the rows without a rate day go before the
    rest is de-duplicated on its own columns (a partial aggregate).
    """
    per_day = materialize_small(coin_map_per_day(basket, time=time), max_days)
    out = prices.join(per_day.select(time), on=time, how="left_semi").dropDuplicates().join(per_day, on=time, how="inner")
    return out.orderBy(*total_order(out, *sort_keys)) if sort_keys else out


def _grouped_means(df: DataFrame, keys: list[str], attributes: list[str], prices: list[str]) -> DataFrame:
    return exact_totals(df, [*keys, *attributes], means={p: p for p in prices})


def peer_mean(
    df: DataFrame,
    manufacturer: str | None,
    keys=("ProdId", "TimeId"),
    prices=("Price_USD", "Price_Original"),
    drop=("RegionId", "MerchantId"),
    manufacturer_column: str = "Processor_Manufacturer",
) -> DataFrame:
    """Rows of one manufacturer (all if ``None``), collapsed to one row per ``keys`` and
    remaining attributes, with each price replaced by its exact mean over the collapsed rows
    (merchants). Filtering first is exact: the manufacturer is an attribute of the product.

    For rows of any columns; the attributes are part of the grouping and are shuffled with it.
    ``DailyPrices.peer_mean`` groups by product and day alone."""
    keys, prices = list(keys), list(prices)
    src = df if manufacturer is None else df.filter(F.col(manufacturer_column) == F.lit(manufacturer))
    dropped = set(drop) | set(keys) | set(prices)
    attributes = [c for c in df.columns if c not in dropped]
    return _grouped_means(src, keys, attributes, prices).select(*[c for c in df.columns if c not in set(drop)])


@dataclass
class DailyPrices:
    """Prices of the kept products on days with rates (G2 to G4), as three narrow tables: the
    price fact, the products and one row per day. The reports shuffle price columns only."""

    prices: DataFrame
    products: DataFrame
    days: DataFrame
    few_days: bool
    product_key: str = "ProdId"
    product_id: str = "Id"
    time: str = "TimeId"
    max_products: int = BROADCAST_MAX_ROWS

    @classmethod
    def of(
        cls,
        prices: DataFrame,
        products: DataFrame,
        basket: DataFrame,
        min_capacity: float = 2,
        capacity: str = "Memory_Capacity",
        max_products: int = BROADCAST_MAX_ROWS,
        max_days: int = BROADCAST_MAX_ROWS,
        time: str = "TimeId",
    ) -> DailyPrices:
        """The per-day table is written once, the products are read where they are used. Equal
        product rows count once, as equal joined rows would."""
        days, few_days = settle(coin_map_per_day(basket, time=time), max_days)
        kept = products.filter(F.col(capacity) >= F.lit(min_capacity)).dropDuplicates()
        return cls(prices, kept, days, few_days, time=time, max_products=max_products)

    def _distinct(self, products: DataFrame, few: bool) -> DataFrame:
        """Distinct prices of the products on rate days: semi-joins where the prices lie, then one
        shuffle of the six columns, in which equal rows have been combined map-side. The prices of
        more products than a broadcast holds pass a bitmap of the wanted products, of fixed size,
        where they lie, so that only those are shuffled by product and met with the exact keys."""
        ids = products.select(F.col(self.product_id).alias(self.product_key))
        rows = self.prices
        if few:
            rows = rows.join(F.broadcast(ids), self.product_key, "left_semi")
        rows = rows.join(self.days.select(self.time), self.time, "left_semi")
        if few:
            return rows.dropDuplicates()
        ids = ids.dropDuplicates()
        if rows.schema[self.product_key].dataType == ids.schema[self.product_key].dataType and byte_equal(ids, [self.product_key]):
            marked = rows.withColumn("__product", F.xxhash64(self.product_key))
            rows = may_be_among(marked, "__product", ids.select(F.xxhash64(self.product_key).alias("__product"))).drop("__product")
        return join_dimension(rows, ids, self.product_key, self.product_key, self.max_products, distinct=True)

    def _few(self, products: DataFrame) -> bool:
        probe = products.agg(*size_probe(products)).first()
        return fits_broadcast(probe["rows"], probe["bytes"], self.max_products)

    def _joined(self, rows: DataFrame, products: DataFrame, few: bool) -> DataFrame:
        """The rows with the products' and the day's columns. Broadcasts keep rows where they are
        and in their order."""
        if few:
            out = rows.join(F.broadcast(products.withColumnRenamed(self.product_id, self.product_key)), self.product_key, "inner")
        else:  # the join reads its rows more than once
            rows, _ = stage(rows)
            out = join_dimension(rows, products, self.product_key, self.product_id, self.max_products)
        return out.join(self.days, self.time, "inner")

    def attached(self, sort: bool = True) -> DataFrame:
        """``attach_daily_map(enrich_facts(prices, products), basket)``: ordered by product and
        day, then by the other price columns. If the products and days are few enough to be
        broadcast, the rows are ranged by their six columns before the joins, and each task
        sorts what it has at the end. More products meet the prices in one shuffle by product, in
        which the joined rows are also de-duplicated; the day's map is joined after the ranging."""
        few = self._few(self.products)
        order = total_order(self.prices, self.product_key, self.time)
        if few:
            rows = self._distinct(self.products, few)
            if sort and self.few_days:
                rows = rows.repartitionByRange(*order)
            out = self._joined(rows, self.products, few)
        else:
            rows = self.prices.join(self.days.select(self.time), self.time, "left_semi")
            out = join_dimension(rows, self.products, self.product_key, self.product_id, self.max_products, distinct=True)
            if sort and self.few_days:
                out = out.repartitionByRange(*order)
            out = out.join(self.days, self.time, "inner")
        if not sort:
            return out
        return out.orderBy(*(order if self.few_days else total_order(out, self.product_key, self.time)))

    def peer_mean(
        self,
        manufacturer: str | None,
        means=("Price_USD", "Price_Original"),
        manufacturer_column: str = "Processor_Manufacturer",
    ) -> DataFrame:
        """``peer_mean(attached, manufacturer)``, grouped by product and day alone: product
        attributes and the day's columns follow from those and are joined to the means."""
        products = self.products
        if manufacturer is not None:
            products = products.filter(F.col(manufacturer_column) == F.lit(manufacturer))
        few = self._few(products)
        grouped = _grouped_means(self._distinct(products, few), [self.product_key, self.time], [], list(means))
        return self._joined(grouped, products, few)


def period_comparison(
    df: DataFrame,
    time_dim: DataFrame,
    time: str = "TimeId",
    time_id: str = "Id",
    year: str = "Year",
    product: str = "ProdId",
) -> DataFrame:
    """Each product-day next to its product-year mean price and the year's mean daily rate
    (averaged over product rows), rounded for reporting.

    The product-day rows with their year, and only the columns the report has, are written once
    and read by the three branches (rows, product-year means, year means), so the upstream plan
    runs once. The year means are a group-by on ``Year`` (tiny, broadcast: at most one row per day
    of the size-checked time dimension); the product-year means are a group-by joined back on
    (product, year), where AQE can split a hot pair across tasks. Means are exact.
    """
    days = time_dim.select(time_id, year)
    probe = days.agg(*size_probe(days)).first()
    small = fits_broadcast(probe["rows"], probe["bytes"])
    days = F.broadcast(days) if small else days
    reported = [product, time, *COMPARED]
    rows, _ = stage(df.select(*reported).join(days, df[time] == days[time_id], "inner").select(*reported, year))
    by_product_year = exact_totals(rows, [product, year], means={"Avg_Price_USD": "Price_USD"})
    by_year = exact_totals(rows, [year], means={"Year_Avg_Crypto_Rate": "Avg_Crypto_Rate"})
    by_year = F.broadcast(by_year) if small else by_year
    out = join_on_keys(join_on_keys(rows, by_product_year, [product, year]), by_year, [year])
    # The report's column names.
    return out.select(
        time,
        F.col("Processor_Manufacturer").alias("CPU_Producer"),
        "Processor",
        F.round("Memory_Capacity", 0).alias("GB"),
        F.col("GPU_Manufacturer").alias("GPU_Producer"),
        "Number_Of_Mineable_Coins",
        F.round("Avg_Crypto_Rate", 2).alias("Daily_Avg_Crypto_Rate"),
        F.round("Year_Avg_Crypto_Rate", 2).alias("Year_Avg_Crypto_Rate"),
        F.round("Price_USD", 2).alias("Price_USD"),
        F.round("Price_Original", 2).alias("Price_Original"),
        F.round("Avg_Price_USD", 2).alias("Avg_Price_USD"),
    )


__all__ = [
    "COMPARED",
    "OHLC",
    "DailyPrices",
    "attach_daily_map",
    "coin_map_per_day",
    "daily_basket",
    "enrich_facts",
    "peer_mean",
    "period_comparison",
]
