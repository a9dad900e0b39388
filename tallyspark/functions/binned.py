"""Sums and means of doubles that do not depend on row order or partitioning.

A finite double is an integer times a power of two. Its exponent names a bin of ``WIDTH`` bits;
within the bin the value is split into four limbs of 24 bits, small integers whose sums are exact
longs (up to 2**39 rows a group and bin). ``partial_totals`` groups by the keys and the bin, so it
combines map-side like any other sum, and a group has as many rows as its values have bins: one
or two as a rule, 88 at most. ``final_totals`` carries the limbs of a group's bins into one long
number, rounds it once and scales it: the result is within one unit in the last place of the exact
sum of the doubles, from the smallest to the largest, cancellation included.

Nulls are skipped; a group with nulls only has the sum and mean null. Infinities and NaN follow
the rules of plain sums (they are summed apart, and decide the result if there are any). Integers
and decimals are exact in Spark's own sums, which are used for them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 24  # bits of a bin and of a limb
LIMBS = 4
#: The lowest bit of a bin's values lies above ``WIDTH * bin - _BELOW``: 52 bits of a double below
#: its leading one, and room for a logarithm that is one off next to a power of two.
_BELOW = 54
_BASE = 1 << WIDTH
_BIN, _STATE = "__bin", "__state"


def _power_of_two(exponent: Column) -> tuple[Column, Column]:
    """Two factors whose product is ``2 ** exponent``, each within the range of doubles."""
    half = F.floor(exponent / 2)
    return F.pow(F.lit(2.0), half), F.pow(F.lit(2.0), exponent - half)


def _is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def _bin_of(x: Column) -> Column:
    """The bin of a finite value (0 for 0), null for others."""
    return F.when(_is_finite(x), F.coalesce(F.floor(F.floor(F.log2(F.abs(x))) / WIDTH), F.lit(0)))


def _limbs_of(x: Column, at: Column) -> list[Column]:
    """The value over the bin's lowest bit, an integer, in base ``2 ** WIDTH``, lowest first."""
    first, second = _power_of_two(F.lit(_BELOW) - at * WIDTH)
    rest, out = x * first * second, []
    for i in range(LIMBS - 1, 0, -1):
        limb = (rest / float(_BASE**i)).cast("long")
        out.append(limb)
        rest = rest - limb * float(_BASE**i)
    return [*reversed([*out, rest.cast("long")])]


def _floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def partial_totals(df: DataFrame, keys: Iterable[str], measures: Mapping[str, str], others: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key and bin of each measure: ``keys``, per measure ``<out>__bin`` and
    ``<out>__state`` (limbs, count, sum of the values that are not finite), and the further
    aggregates ``others``. It has one aggregation, so it runs on a stream as well."""
    keys = list(keys)
    values = {out: f"__value_{i}" for i, out in enumerate(measures)}
    rows = df.withColumns({v: F.col(measures[out]).cast("double") for out, v in values.items()})
    rows = rows.withColumns({out + _BIN: _bin_of(F.col(v)) for out, v in values.items()})
    aggregates = []
    for i, (out, v) in enumerate(values.items()):
        x, at = F.col(v), F.col(out + _BIN)
        aggregates += [F.sum(F.coalesce(limb, F.lit(0))).alias(f"__limb_{i}_{j}") for j, limb in enumerate(_limbs_of(F.when(at.isNotNull(), x), at))]
        aggregates += [F.count(x).alias(f"__count_{i}"), F.sum(F.when(~_is_finite(x), x)).alias(f"__odd_{i}")]
    aggregates += [c.alias(name) for name, c in (others or {}).items()]
    grouped = rows.groupBy(*keys, *[out + _BIN for out in values]).agg(*aggregates)
    states = [
        F.struct(
            F.array(*[F.col(f"__limb_{i}_{j}") for j in range(LIMBS)]).alias("limbs"),
            F.col(f"__count_{i}").alias("count"),
            F.col(f"__odd_{i}").alias("odd"),
        ).alias(out + _STATE)
        for i, out in enumerate(values)
    ]
    return grouped.select(*keys, *[out + _BIN for out in values], *states, *(others or {}))


def state_names(df: DataFrame) -> list[str]:
    """The measures a frame of ``partial_totals`` holds; none for other frames."""
    return [c.removesuffix(_BIN) for c in df.columns if c.endswith(_BIN) and c.removesuffix(_BIN) + _STATE in df.columns]


def identity(df: DataFrame, keys: Iterable[str]) -> list[str]:
    """Columns that identify a row of ``partial_totals``: the keys and the bins."""
    return [*keys, *[out + _BIN for out in state_names(df)]]


def _carried(digits: Column) -> Column:
    """Digits in ``[0, 2 ** WIDTH)`` with the same total, lowest first, and what is left over:
    0, or -1 if the total is negative."""

    def step(state: Column, value: Column) -> Column:
        total = value + state["carry"]
        digit = F.pmod(total, F.lit(_BASE))
        return F.struct(
            F.shiftright(total - digit, WIDTH).alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits")
        )

    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))
    return F.aggregate(digits, start, step)


def _add_result(df: DataFrame, parts: str, count: str, odd: str, out: str, mean: bool) -> DataFrame:
    """Add ``out``: the exact total of a group's ``parts`` (bin and limbs), rounded once."""
    bins = F.transform(parts, lambda p: p["bin"])
    # two positions above the highest limb take the carries, four below the lowest are zero
    df = df.withColumn("__low", F.array_min(bins) - LIMBS).withColumn("__high", F.array_max(bins) + LIMBS + 1)
    positions = F.sequence("__low", "__high")

    def digit(at: Column) -> Column:
        add = lambda total, p: total + F.coalesce(F.get(p["limbs"], (at - p["bin"]).cast("int")), F.lit(0))
        return F.aggregate(parts, F.lit(0).cast("long"), add)

    df = df.withColumn("__digits", F.transform(positions, digit))
    df = df.withColumn("__plus", _carried(F.col("__digits")))
    negative = F.col("__plus.carry") < 0
    size = F.when(negative, _carried(F.transform("__digits", lambda d: -d))["digits"]).otherwise(F.col("__plus.digits"))
    df = df.withColumn("__size", F.reverse(size))
    df = df.withColumn("__first", F.array_position(F.transform("__size", lambda d: d != 0), True).cast("int"))
    df = df.withColumn("__top", F.slice("__size", F.greatest(F.col("__first"), F.lit(1)), 4))
    top = [F.element_at("__top", i + 1) for i in range(4)]
    upper, lower = top[0] * _BASE + top[1], top[2] * _BASE + top[3]
    rounded = upper.cast("double") * float(_BASE**2) + lower.cast("double")
    if mean:
        rounded = rounded / F.col(count)
    first, second = _power_of_two((F.col("__high") - F.col("__first") - 2) * WIDTH - _BELOW)
    total = F.when(F.col("__first") == 0, F.lit(0.0)).otherwise(F.when(negative, -rounded).otherwise(rounded) * first * second)
    result = F.when(F.col(count) > 0, F.coalesce(F.col(odd), total))
    return df.withColumn(out, result).drop("__low", "__high", "__digits", "__plus", "__size", "__first", "__top")


def final_totals(
    partials: DataFrame, keys: Iterable[str], means: Iterable[str] = (), others: Mapping[str, Column] | None = None
) -> DataFrame:
    """``keys``, the measures of ``partial_totals`` as sums (as means those in ``means``) and the
    further aggregates ``others`` over the partial rows."""
    keys, means, outs = list(keys), set(means), state_names(partials)
    aggregates = []
    for i, out in enumerate(outs):
        part = F.struct(F.col(out + _BIN).alias("bin"), F.col(f"{out}{_STATE}.limbs").alias("limbs"))
        aggregates += [
            F.collect_list(F.when(F.col(out + _BIN).isNotNull(), part)).alias(f"__parts_{i}"),
            F.sum(f"{out}{_STATE}.count").alias(f"__count_{i}"),
            F.sum(f"{out}{_STATE}.odd").alias(f"__odd_{i}"),
        ]
    aggregates += [c.alias(name) for name, c in (others or {}).items()]
    found = partials.groupBy(*keys).agg(*aggregates)
    for i, out in enumerate(outs):
        found = _add_result(found, f"__parts_{i}", f"__count_{i}", f"__odd_{i}", out, out in means)
    return found.select(*keys, *outs, *(others or {}))


def exact_totals(
    df: DataFrame,
    keys: Iterable[str],
    sums: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    counts: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group by ``keys``: exact sums and means (``out -> column``), with counts of columns and
    maxima beside them. Sums of integers and decimals keep Spark's type."""
    sums, means, counts, maxima = dict(sums or {}), dict(means or {}), dict(counts or {}), dict(maxima or {})
    plain = {out: c for out, c in sums.items() if not _floating(df, c)}
    binned = {out: c for out, c in sums.items() if out not in plain} | means
    first = {out: F.sum(c) for out, c in plain.items()}
    first |= {out: F.count(c) for out, c in counts.items()} | {out: F.max(c) for out, c in maxima.items()}
    if not binned:
        return df.groupBy(*keys).agg(*[c.alias(out) for out, c in first.items()])
    then = {out: F.sum(out) for out in [*plain, *counts]} | {out: F.max(out) for out in maxima}
    found = final_totals(partial_totals(df, keys, binned, first), keys, means, then)
    # sums of partial sums widen decimals once more; keep the type of one sum
    kinds = {f.name: f.dataType for f in df.agg(*[F.sum(c).alias(out) for out, c in plain.items()]).schema.fields} if plain else {}
    return found.withColumns({out: F.col(out).cast(kind) for out, kind in kinds.items()}) if kinds else found
