"""Stand-in input tables derived from the generated Parquet tables (see FIXTURES.md).

The SQL text defines the tables; it runs in DuckDB (as CTEs of the oracle queries) and in Spark
(here, once per data directory, written as Parquet under the shared checkpoint folder). The trade
feed's rows are made in Spark by a plan that shuffles its facts less (``_trade_base``). The modulo
expressions in the text only choose names (a supplier's flow is ``Export`` or ``Re-Export``, a
country has a suffix, some flows are null), so one-sided countries and null flows exist;
every source row is kept, and every query reads the whole derived table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.joins import broadcast_if_small, materialize_small
from tallyspark.session import scratch_path
from tallyspark.scratch import Scratch
from tallyspark.functions.columns import cast_columns
from tallyspark.sources.files import complete_copy, content_bytes, materialize
from tallyspark.sources.testdata import memo_scan, read_table, register_tables

# The stand-in view definitions.
FIXTURE_SQL = {
    "trade_base": """
select translate(n_name,'0123456789','abcdefghij') as country_or_area, cast(year(o_orderdate) as int) as year, cast(p_partkey as string) as comm_code, p_name as commodity, p_type as category, case when s_suppkey % 10 < 2 then 'Export' else 'Re-Export' end as flow, cast(round(l_extendedprice*100) as bigint) as trade_usd
from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey join supplier on l_suppkey=s_suppkey join nation on s_nationkey=n_nationkey
union all
select translate(n_name,'0123456789','abcdefghij'), cast(year(o_orderdate) as int), cast(p_partkey as string), p_name, p_type, case when o_orderkey % 50 = 0 then null when o_custkey % 10 < 8 then 'Import' else 'Re-Import' end, cast(round(l_extendedprice*100) as bigint)
from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
""",
    "trade": """
select country_or_area,year,comm_code,commodity,category,flow,trade_usd from trade_base
union all select country_or_area,year,'TOTAL','ALL COMMODITIES','all_commodities',flow,cast(sum(trade_usd) as bigint) from trade_base group by country_or_area,year,flow
union all select 'Bloc-25',year,comm_code,commodity,category,flow,trade_usd from trade_base where year=2000
""",
    "loans_ibrd": """
select translate(n_name,'0123456789','abcdefghij') as country, cast(round(l_extendedprice*100) as bigint) as original_principal_amount, l_discount*100 as interest_rate, case o_orderstatus when 'F' then 'Fully Repaid' when 'P' then (case when l_linenumber=1 then 'Fully Cancelled' else 'Disbursed' end) else 'Repaying' end as loan_status,
concat(substr(cast(l_shipdate as string),6,2),'/',substr(cast(l_shipdate as string),9,2),'/',substr(cast(l_shipdate as string),1,4),' 00:00:00') as last_repayment_date
from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
""",
    "credits_ida": """
select concat(translate(n_name,'0123456789','abcdefghij'), case when s_suppkey % 10 < 2 then '' else ' (other)' end) as country, cast(round(l_extendedprice*100) as bigint) as original_principal_amount, l_tax*100 as service_charge_rate, case when l_returnflag='A' then 'Fully Repaid' when l_returnflag='N' and l_linestatus='F' then 'Fully Cancelled' else 'Repaying' end as credit_status,
concat(substr(cast(l_shipdate as string),6,2),'/',substr(cast(l_shipdate as string),9,2),'/',substr(cast(l_shipdate as string),1,4),' 00:00:00') as last_repayment_date
from lineitem join supplier on l_suppkey=s_suppkey join nation on s_nationkey=n_nationkey
""",
    "crypto_rate": """
select substr(cast(o_orderdate as string),1,10) as TimeId, substr(o_orderpriority,1,1) as CodeId, cast(min_by(o_totalprice,o_orderkey) as string) as Open, cast(max_by(o_totalprice,o_orderkey) as string) as Close, cast(max(o_totalprice) as string) as High, cast(min(o_totalprice) as string) as Low from orders group by 1,2
""",
    "crypto_dim": """
select distinct substr(o_orderpriority,1,1) as Id, concat('C',substr(o_orderpriority,1,1)) as Code, substr(o_orderpriority,3) as Currency_Name, case when substr(o_orderpriority,1,1)='5' then '0' else '1' end as Is_Mineable from orders
""",
    "gpu_price": """
select cast(l_partkey as string) as ProdId, substr(cast(l_shipdate as string),1,10) as TimeId, cast(s_nationkey as string) as RegionId, cast(l_suppkey as string) as MerchantId, cast(l_extendedprice as string) as Price_USD, cast(l_extendedprice*(1-l_discount) as string) as Price_Original from lineitem join supplier on l_suppkey=s_suppkey
""",
    "gpu_dim": """
select cast(p_partkey as string) as Id, p_brand as Processor_Manufacturer, p_name as Processor, p_type as GPU_Manufacturer, cast(p_size/10.0 as string) as Memory_Capacity from part
""",
    "time_dim": """
select distinct substr(cast(d as string),1,10) as Id, cast(year(d) as string) as Year from (select l_shipdate as d from lineitem union all select o_orderdate from orders) t
""",
}

# Row groups of the written stand-in tables: a reader splits a Parquet file only between row
# groups, so they are sized for about two scan tasks per core, between 1 MB (small data
# still spreads over the cores) and 128 MB (the usual size at cluster scale).
MIN_ROW_GROUP_BYTES = 1 << 20
MAX_ROW_GROUP_BYTES = 128 << 20
LAYOUT_VERSION = "small-rebalanced-rg-by-input-size"

#: Below this row group size a reader cannot cut a file to one scan task per core (by default it
#: packs splits up to 4 MB), so small tables are dealt out evenly over files when written. Larger
#: ones are written where their rows lie: dealing them out would sort and shuffle all of them.
SPLIT_BYTES = 4 << 20

#: Sellers are broadcast up to this many (and 64 MB): a key and a few nation keys each.
MAX_SELLERS = 2_000_000


def row_group_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Row group size for stand-in tables derived from ``sf_dir`` (file metadata only)."""
    per_task = content_bytes(spark, sf_dir) // (2 * spark.sparkContext.defaultParallelism)
    return int(min(max(per_task, MIN_ROW_GROUP_BYTES), MAX_ROW_GROUP_BYTES))

# Views that other views read.
FIXTURE_DEPS = {"trade": ("trade_base",)}

# Text feeds are cast once at ingest (the reference compares and adds strings).
INGEST_TYPES = {
    "crypto_rate": {"Open": "double", "Close": "double", "High": "double", "Low": "double"},
    "crypto_dim": {"Is_Mineable": "int"},
    "gpu_price": {"Price_USD": "double", "Price_Original": "double"},
    "gpu_dim": {"Memory_Capacity": "double"},
    "time_dim": {"Year": "int"},
}

_DUCKDB_TYPES = {"double": "DOUBLE", "int": "INTEGER"}


def _order(names) -> list[str]:
    ordered: list[str] = []

    def visit(n: str) -> None:
        for d in FIXTURE_DEPS.get(n, ()):
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return ordered


def _key(sf_dir: str, name: str) -> str:
    text = f"{sf_dir.rstrip('/')}\n{LAYOUT_VERSION}\n" + "\n".join(FIXTURE_SQL[n] for n in _order([name]))
    return hashlib.sha1(text.encode()).hexdigest()[:16]


def _nations_of(parties: DataFrame, key: str, nation: str, out: str) -> DataFrame:
    """One row per party key with the nation keys of all its rows: a left join to it repeats no row,
    and the list gives each row as many partners as an inner join would."""
    return parties.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(nation).alias(out))


def _trade_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``FIXTURE_SQL["trade_base"]``: both sides of a line come from one join of lines, orders and
    parts. Sellers and buyers are carried through it as nation keys; each line becomes its export
    and import rows afterwards, where the joined rows lie, so a line is shuffled once per large
    table and without any text."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("trade_usd")
    )
    sellers = materialize_small(_nations_of(read_table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey", "sellers"), MAX_SELLERS)
    buyers = _nations_of(read_table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", "buyers")
    importing = F.when(F.col("o_orderkey") % 50 == 0, None).when(F.col("o_custkey") % 10 < 8, "Import").otherwise("Re-Import")
    orders = (
        read_table(spark, sf_dir, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("o_orderkey", F.year("o_orderdate").cast("int").alias("year"), importing.alias("importing"), "buyers")
    )
    parts = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("commodity"), F.col("p_type").alias("category"))
    exporting = F.when(F.col("l_suppkey") % 10 < 2, "Export").otherwise("Re-Export")
    joined = (
        lines.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select("l_orderkey", "l_partkey", "trade_usd", exporting.alias("exporting"), "sellers")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .drop("l_orderkey", "o_orderkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )

    def sides(nations: str, flow: str):
        found = F.transform(nations, lambda n: F.struct(n.alias("nation"), F.col(flow).alias("flow")))
        return F.coalesce(found, F.array().cast("array<struct<nation:int,flow:string>>"))

    rows = joined.withColumn("side", F.explode(F.concat(sides("sellers", "exporting"), sides("buyers", "importing"))))
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", F.translate("n_name", "0123456789", "abcdefghij").alias("country_or_area"))
    return rows.join(broadcast_if_small(nations), F.col("side.nation") == F.col("n_nationkey")).select(
        "country_or_area", "year", F.col("p_partkey").cast("string").alias("comm_code"), "commodity", "category", "side.flow", "trade_usd"
    )


def _trade_totals(base: DataFrame) -> DataFrame:
    return base.groupBy("country_or_area", "year", "flow").agg(F.sum("trade_usd").cast("bigint").alias("trade_usd")).select(
        "country_or_area", "year", F.lit("TOTAL").alias("comm_code"), F.lit("ALL COMMODITIES").alias("commodity"),
        F.lit("all_commodities").alias("category"), "flow", "trade_usd",
    )


def _trade(spark: SparkSession, base: DataFrame, totals: DataFrame) -> DataFrame:
    """``FIXTURE_SQL["trade"]`` over the written rows and totals (one scan of both folders), which
    need no second copy."""
    bloc = base.where(F.col("year") == 2000).withColumn("country_or_area", F.lit("Bloc-25"))
    files = [*base.inputFiles(), *totals.inputFiles()]
    folders = sorted({f.rpartition("/")[0] for f in files})
    return spark.read.schema(base.schema).parquet(*folders).unionByName(bloc)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in table ``name`` for ``sf_dir``: built by Spark on first use, written as Parquet
    in the shared folder, then always read from there (``trade``: from the folders of its base rows
    and its totals)."""

    def written(label: str, table) -> DataFrame:
        path = scratch_path(spark, "fixtures", f"{label}-{_key(sf_dir, name)}")

        def build() -> DataFrame:
            done = complete_copy(spark, path)
            if done:
                return spark.read.parquet(done)
            row_group = row_group_bytes(spark, sf_dir)
            with Scratch(spark):
                df = table()
                return materialize(df.hint("rebalance") if row_group < SPLIT_BYTES else df, path, row_group_bytes=row_group)

        return memo_scan(spark, path, build)

    def by_sql() -> DataFrame:
        register_tables(spark, sf_dir)
        return spark.sql(FIXTURE_SQL[name])

    if name == "trade":
        base = fixture(spark, sf_dir, "trade_base")
        return _trade(spark, base, written("trade-totals", lambda: _trade_totals(base)))
    return written(name, (lambda: _trade_base(spark, sf_dir)) if name == "trade_base" else by_sql)


def typed_fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``fixture`` with the ingest casts of ``INGEST_TYPES`` applied."""
    return cast_columns(fixture(spark, sf_dir, name), INGEST_TYPES.get(name, {}))


def prepare(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Build every stand-in table up front (the bench times this separately)."""
    for name in names or FIXTURE_SQL:
        fixture(spark, sf_dir, name)


def oracle_ctes(names) -> str:
    """``WITH`` clause defining the named views (and what they read) for the DuckDB oracle.
    Typed views are exposed as ``<name>_typed``."""
    ctes = []
    wanted = [n[: -len("_typed")] if n.endswith("_typed") else n for n in names]
    for n in _order(wanted):
        ctes.append(f"{n} AS ({FIXTURE_SQL[n].strip()})")
    for n in names:
        if n.endswith("_typed"):
            base = n[: -len("_typed")]
            types = INGEST_TYPES[base]
            casts = ", ".join(f"TRY_CAST({c} AS {_DUCKDB_TYPES[t]}) AS {c}" for c, t in types.items())
            ctes.append(f"{n} AS (SELECT * REPLACE ({casts}) FROM {base})")
    return "WITH " + ",\n".join(ctes) + "\n"
