"""Exact interpolated percentiles per group, for groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one task's memory.
``select_percentiles`` narrows in on the wanted ranks instead, by the leading bits of the values:

1. count rows per (group, first 22 bits): a partial aggregate, so a hot group leaves each
   task as at most one row per bucket; a running total over a group's buckets tells
   which buckets hold the wanted ranks;
2. count exact values, but only of the rows in those buckets; running totals over the next 21
   bits and then over the values that share all 43 find the values at the ranks.

So no task ever orders more than 2**21 entries, however close the values of a group lie. Both passes
over the data are column-pruned, and the whole is one lazy plan, the same at every size; the table
of wanted buckets is small, and adaptive execution broadcasts it when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits below a bucket's number, and below that of a part of a bucket.
BUCKET_BITS, PART_BITS = 42, 21

_MANTISSA, _LEAST_NORMAL = 2.0**52, 2.0**-1022


class Percentile(NamedTuple):
    """One wanted result column: quantile ``q`` of the rows that pass ``where``."""

    name: str
    q: float
    where: Column | None = None


def approx_percentile_columns(value: str, wanted: Sequence[Percentile], accuracy: int = 10_000) -> list[Column]:
    """Sketch-based variant: bounded memory in one pass, returns a data value near the rank."""
    return [
        F.percentile_approx(
            F.col(value) if p.where is None else F.when(p.where, F.col(value)), F.lit(p.q), F.lit(accuracy)
        ).alias(p.name)
        for p in wanted
    ]


def ordered_bits(v: Column) -> Column:
    """A BIGINT in the order of the doubles, one for each: the bits of the magnitude, negated below zero. Both zeros are 0,
    NaN sorts last, as it does in Spark."""
    size = F.abs(v)
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    scaled = size * F.pow(F.lit(2.0), -guess)  # exact; 1 to 2 unless the logarithm was rounded across a power of two
    exponent = guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    fraction = F.when(scaled >= 2, scaled / 2).when(scaled < 1, scaled * 2).otherwise(scaled) - 1
    bits = (
        F.when(size < _LEAST_NORMAL, (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .when(size == F.lit(float("inf")), F.lit(2047 * 2**52))
        .otherwise((exponent + 1023) * F.lit(2**52) + (fraction * F.lit(_MANTISSA)).cast("long"))
    )
    return F.when(F.isnan(v), F.lit(2**63 - 1)).when(v < 0, -bits).otherwise(bits)


def _bucket(v: Column) -> Column:
    return F.shiftright(ordered_bits(v), BUCKET_BITS)


def _matched(rows: DataFrame, hit: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with the targets of their bucket; those of other buckets leave."""
    return rows.join(hit, reduce(lambda a, b: a & b, (rows[c].eqNullSafe(hit[f"_r_{c}"]) for c in on)))


def _measures(wanted: Sequence[Percentile]) -> list[Column | None]:
    """The distinct row conditions among the wanted percentiles."""
    found: list[Column | None] = []
    for p in wanted:
        if not any(p.where is m for m in found):
            found.append(p.where)
    return found


def _running(counts: DataFrame, within: Sequence[str], order: str, n_measures: int) -> DataFrame:
    """Rows before each bucket or value, per measure. The window holds counts, not rows."""
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn(
        "_before", F.array(*(F.sum(F.col("_n")[m]).over(w) - F.col("_n")[m] for m in range(n_measures)))
    )


def _keep_hits(located: DataFrame) -> DataFrame:
    """Reduce each row's targets to those whose rank falls on it, made relative to it."""

    def inside(t: Column) -> Column:
        m = t["m"]
        return (t["rank"] >= F.col("_before")[m]) & (t["rank"] < F.col("_before")[m] + F.col("_n")[m])

    def relative(t: Column) -> Column:
        return t.withField("rank", t["rank"] - F.col("_before")[t["m"]])

    return (
        located.withColumn("_targets", F.transform(F.filter("_targets", inside), relative))
        .filter(F.size("_targets") > 0)
        .drop("_n", "_before")
    )


def select_percentiles(df: DataFrame, keys: Sequence[str], value: str, wanted: Sequence[Percentile]) -> DataFrame:
    """Percentiles by rank selection: one row per group that has a value, exact at any size."""
    keys = list(keys)
    measures = _measures(wanted)
    n = len(measures)
    rows = (
        df.select(
            *keys,
            F.col(value).cast("double").alias("_v"),
            *(
                (F.lit(1) if m is None else F.when(m, 1).otherwise(0)).cast("long").alias(f"_w{i}")
                for i, m in enumerate(measures)
            ),
        )
        .filter(F.col("_v").isNotNull())
        .withColumn("_b", _bucket(F.col("_v")))
    )
    counted = F.array(*(F.sum(f"_w{m}") for m in range(n))).alias("_n")

    whole = Window.partitionBy(*keys)
    totals = [F.sum(F.col("_n")[m]).over(whole) for m in range(n)]
    targets = []
    for i, p in enumerate(wanted):
        m = next(j for j, w in enumerate(measures) if w is p.where)
        position = F.lit(float(p.q)) * (F.col("_totals")[m] - 1)
        for side, rank in enumerate((F.floor(position), F.ceil(position))):
            targets.append(
                F.struct(
                    F.lit(2 * i + side).alias("j"),
                    F.lit(m).alias("m"),
                    rank.cast("long").alias("rank"),
                    (position - F.floor(position)).alias("share"),
                )
            )
    buckets = _running(rows.groupBy(*keys, "_b").agg(counted), keys, "_b", n)
    hit = _keep_hits(
        buckets.withColumn("_totals", F.array(*totals)).withColumn("_targets", F.array(*targets)).drop("_totals")
    )
    hit = hit.select(*(F.col(c).alias(f"_r_{c}") for c in [*keys, "_b"]), "_targets")
    values = _matched(rows, hit, [*keys, "_b"]).groupBy(*keys, "_b", "_v").agg(counted, F.any_value("_targets").alias("_targets"))
    values = values.withColumn("_part", F.shiftright(ordered_bits(F.col("_v")), PART_BITS))
    summed = F.array(*(F.sum(F.col("_n")[m]) for m in range(n))).alias("_n")
    parts = values.groupBy(*keys, "_b", "_part").agg(summed, F.any_value("_targets").alias("_targets"))
    hit_part = _keep_hits(_running(parts, [*keys, "_b"], "_part", n)).drop("_b")
    hit_part = hit_part.select(*(F.col(c).alias(f"_r_{c}") for c in [*keys, "_part"]), "_targets")
    near = _matched(values.drop("_targets"), hit_part, [*keys, "_part"])
    found = _keep_hits(_running(near, [*keys, "_part"], "_v", n)).select(*keys, "_v", F.inline("_targets"))

    columns = []
    for i, p in enumerate(wanted):
        low = F.max(F.when(F.col("j") == 2 * i, F.col("_v")))
        high = F.max(F.when(F.col("j") == 2 * i + 1, F.col("_v")))
        share = F.max(F.when(F.col("j") == 2 * i, F.col("share")))
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * share).alias(p.name))
    return found.groupBy(*keys).agg(*columns)
