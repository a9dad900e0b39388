"""tallyspark: parameterised PySpark DataFrame operators for trade, lending and price
analysis on tables and file streams.

Subpackages:
    functions  column expressions (labels, dates, ratios, exact sums and means, ingest casts)
    operators  DataFrame -> DataFrame reports (ranking, balance, lending, market, quality)
    sources    CSV/Parquet ingest and the generated test tables
    plans      the reference's jobs, stand-in fixtures, and the registered queries with
               their DuckDB oracle SQL
    streaming  Structured Streaming over snapshot files
"""

from tallyspark import functions, operators, plans, sources, streaming
from tallyspark.plans import jobs
from tallyspark.session import build_session, cluster_conf, scratch_path, shared_root

__version__ = "0.1.0"

__all__ = [
    "build_session",
    "cluster_conf",
    "functions",
    "jobs",
    "operators",
    "plans",
    "scratch_path",
    "shared_root",
    "sources",
    "streaming",
]
