"""Data-quality operators: row cleaning (T1), duplicate keys (Q1), distinct values (Q2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.columns import as_list
from tallyspark.operators.joins import stage

# Fixed value: a country/area name holding a digit is an aggregate bloc, not a country.
DIGIT_PATTERN = "[0-9]"

#: Bits of the duplicate check's filter: 16 MB on each executor.
FILTER_BITS = 1 << 27


def clean_rows(
    df: DataFrame,
    text_column: str = "country_or_area",
    required=("flow",),
    pattern: str = DIGIT_PATTERN,
) -> DataFrame:
    """Keep rows whose ``text_column`` does not match ``pattern`` and whose ``required``
    columns are not null. A null ``text_column`` is dropped too (``NOT (NULL RLIKE p)`` is
    null). Narrow: two filters, no shuffle; the null checks reach the Parquet scan."""
    cond = ~F.col(text_column).rlike(pattern)
    for c in as_list(required):
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def byte_equal(df: DataFrame, keys: list[str]) -> bool:
    """Keys whose equality is that of their bytes, so that equal keys share a fingerprint."""
    plain = (T.BinaryType, T.BooleanType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(t, plain) or t == T.StringType() for t in (df.schema[k].dataType for k in keys))


def duplicate_keys(
    df: DataFrame,
    keys,
    count_column: str = "number_of_occurrences",
    min_count: int = 2,
    hash_prefilter: bool = False,
    fingerprints=None,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Key values (one or several columns) that occur at least ``min_count`` times, with
    their count. A null key is a group of its own and is reported like any other.

    The count is combinable, so a hot key is pre-aggregated map-side and never lands whole
    in one task. For wide keys (long texts) ``hash_prefilter`` adds two passes that shuffle no
    key: the first counts 96-bit fingerprints (xxhash64 + murmur3, combined map-side) and sets a
    bit for each repeated one in a Bloom filter of ``filter_bits`` bits, whose size does not grow
    with the data; the second drops, where they lie, the rows whose bit is not set. What is left
    (repeated keys, and single ones that share a bit) is counted by the exact key as above, so
    neither colliding fingerprints nor a full filter can change the result, and a hot key is
    combined map-side here too. The prefilter is refused for keys that can be equal without equal
    bytes (collated text, floats, nested values). ``fingerprints`` replaces the two fingerprint
    columns (tests force collisions).
    """
    keys = as_list(keys)
    if hash_prefilter and not byte_equal(df, keys):
        raise ValueError("hash_prefilter needs keys that are equal only when their bytes are")
    rows = df.select(*keys)
    if hash_prefilter:
        fp1, fp2 = fingerprints or (F.xxhash64(*keys), F.hash(*keys))
        marked = rows.withColumns({"__fp1": fp1, "__fp2": fp2})
        repeated = marked.groupBy("__fp1", "__fp2").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_count)
        rows = rows.withColumn("__fp1", fp1)
        rows = may_be_among(rows, "__fp1", repeated, filter_bits).select(*keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_column)).filter(F.col(count_column) >= min_count)


def may_be_among(rows: DataFrame, fingerprint: str, members: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose fingerprint (a long) may be that of a member: all that are, and of the others
    about the share of the filter's bits that members set. The filter is a bitmap in pieces of 4 KB,
    built from mergeable partial bitmaps, written once and broadcast: ``bits / 8`` bytes at most,
    however many members there are. Rows are not shuffled."""
    place = F.pmod(F.col(fingerprint), F.lit(bits)) + 1
    piece, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bitmaps, _ = stage(members.groupBy(piece.alias("__piece")).agg(F.bitmap_construct_agg(bit).alias("__bitmap")))
    held = rows.withColumns({"__piece": piece, "__bit": bit}).join(F.broadcast(bitmaps), "__piece")
    byte = F.conv(F.hex(F.substring("__bitmap", F.expr("cast(__bit div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.expr("cast(__bit % 8 as int)")) == 1
    return held.where(is_set).select(*rows.columns)


def duplicate_values(
    df: DataFrame,
    columns,
    column_out: str = "column_name",
    value_out: str = "value",
    count_column: str = "number_of_occurrences",
    min_count: int = 2,
) -> DataFrame:
    """Repeated values of several columns in one pass: the columns are unpivoted to
    (column name, value as text) and counted together, so an extract is scanned and shuffled
    once rather than once per column. Nulls are reported like any other value."""
    cols = as_list(columns)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, column_out, value_out
    )
    return (
        long.groupBy(column_out, value_out)
        .agg(F.count(F.lit(1)).alias(count_column))
        .filter(F.col(count_column) >= min_count)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column in ascending order (null first)."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first())
