"""Business rules as column expressions. All are native, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmeter.session import as_of_column

# Hourly list price in USD per GPU.
PRICE_BOOK = {
    "H100-SXM5-80GB": 4.25,
    "A100-SXM4-80GB": 3.00,
    "A100-PCIe-40GB": 2.21,
    "RTX-4090": 0.74,
    "A10G": 0.90,
}

# Process exit codes with a meaning of their own.
EXIT_OK = 0
EXIT_OOM = 137
EXIT_PLATFORM = 143

# p99 limits in milliseconds by model size.
P99_LIMIT_405B = 8000
P99_LIMIT_70B = 5000
P99_LIMIT_DEFAULT = 2000

# Fixed value: decimals of a computed job cost.
COST_DIGITS = 6

# The two surrogate-key formats in use, as (separator, null token).
KEY_FORMAT_LOCAL = ("||", "_null_")
KEY_FORMAT_PACKAGE = ("-", "_dbt_utils_surrogate_key_null_")

MICROS_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def round_half_away(value: Column, digits: int) -> Column:
    """Round by scaling: the scaled double goes half away from zero.

    Differs from ``F.round`` on decimal ties such as 1.005, whose binary value lies
    below the tie; SQL engines that scale in binary give 1.0 there, and so does this.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


#: Binary exponents of the units in which an exact sum counts, and from which magnitude a value is outside of them.
#: A part of a value is at most 2**31 units, so 2**32 rows fit into the BIGINT sum of a group; ANSI mode stops beyond that.
_UNITS = (34, 2, -30, -62, -94)
_OUTSIDE = 2.0**66


def exact_parts(value: Column) -> Column:
    """Aggregate: the parts of an error-free sum of doubles, as a struct that ``merged_parts`` can add up further.

    Each value is cut into whole numbers of fixed units, 32 bits apart, by rounding to each unit, which is exact for
    doubles; whole numbers add up to the same total in any order. Bits below 2**-94 (a value's own precision down
    to 2e-13, then an absolute 3e-29) are dropped. NaN, infinities and magnitudes from 7e19 on are summed as doubles.
    """
    value = value.cast("double")
    inside = F.when(F.abs(value) < _OUTSIDE, value)
    parts, above = [], None
    for i, unit in enumerate(_UNITS):
        here = F.rint(inside * F.lit(2.0**-unit))
        part = here if above is None else here - above * F.lit(2.0**32)
        parts.append(F.sum(part.cast("long")).alias(f"p{i}"))
        above = here
    return F.struct(*parts, F.sum(F.when(F.abs(value) < _OUTSIDE, 0.0).otherwise(value)).alias("outside"))


def merged_parts(parts: Column) -> Column:
    """Aggregate: parts of groups of groups."""
    names = [*(f"p{i}" for i in range(len(_UNITS))), "outside"]
    return F.struct(*(F.sum(parts[n]).alias(n) for n in names))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once and named, which keeps the expression small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parts_total(parts: Column) -> Column:
    """The double nearest to the exact total; NULL if there was no value."""
    return _let(parts, lambda p: _let(_carried(p), _nearest) + p["outside"])


def _carried(parts: Column) -> Column:
    """The parts as an array in which all but the first are 0 to 2**32 - 1."""
    limb = [F.coalesce(parts[f"p{i}"], F.lit(0).cast("long")) for i in range(len(_UNITS))]
    for i in range(len(limb) - 1, 0, -1):
        limb[i - 1] = limb[i - 1] + F.shiftright(limb[i], 32)
        limb[i] = limb[i].bitwiseAND(0xFFFFFFFF)
    return F.array(*limb)


def _nearest(limb: Column) -> Column:
    """Three parts from the first that counts hold 64 bits or more, and one more bit says whether anything nonzero follows:
    the conversion rounds once, and rightly."""

    def digits(*three: Column) -> Column:
        high, middle, low = (x.cast("decimal(38,0)") for x in three)
        shift = F.expr(f"{2**32}BD")
        return ((high * shift).cast("decimal(38,0)") + middle).cast("decimal(38,0)") * shift + low

    def scaled(whole: Column, rest: Column | None, unit: int) -> Column:
        sticky = F.lit(0) if rest is None else F.when(rest != 0, 1).otherwise(0)
        twice = whole.cast("decimal(38,0)") * F.expr("2BD") + sticky.cast("decimal(1,0)")
        return twice.cast("double") * F.lit(2.0 ** (unit - 1))

    def small(x: Column) -> Column:
        return (x == 0) | (x == -1)

    second = limb[0] * F.lit(2**32) + limb[1]
    third = second * F.lit(2**32) + limb[2]
    return (
        F.when(~small(limb[0]), scaled(digits(limb[0], limb[1], limb[2]), limb[3] + limb[4], _UNITS[2]))
        .when(~small(second), scaled(digits(second, limb[2], limb[3]), limb[4], _UNITS[3]))
        .otherwise(scaled(digits(third, limb[3], limb[4]), None, _UNITS[4]))
    )


def exact_sum(value: Column) -> Column:
    """Sum of doubles without rounding errors: the double nearest to the exact total, the same in any order of the rows."""
    return parts_total(exact_parts(value))


def exact_avg(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def price_per_gpu_hour(gpu_type: Column, book: dict[str, float] | None = None) -> Column:
    """List price of a GPU type, NULL for an unknown one."""
    prices = PRICE_BOOK if book is None else book
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(prices.items())))[gpu_type]


def lenient_boolean(value: Column) -> Column:
    """Boolean cast that turns junk into NULL."""
    return value.try_cast("boolean")


def exited_cleanly(exit_code: Column) -> Column:
    """NULL while the job has no exit code."""
    return exit_code == F.lit(EXIT_OK)


def request_succeeded(status_code: Column) -> Column:
    return status_code == F.lit(200)


def gpu_tier(gpu_type: Column) -> Column:
    return (
        F.when(gpu_type.startswith("H100"), "flagship")
        .when(gpu_type.startswith("A100"), "performance")
        .otherwise("standard")
    )


def model_size_tier(model_id: Column) -> Column:
    return (
        F.when(model_id.contains("405b"), "xl")
        .when(model_id.contains("70b"), "large")
        .when(model_id.contains("34b") | model_id.contains("mixtral"), "medium")
        .otherwise("small")
    )


def p99_limit_ms(model_id: Column) -> Column:
    return (
        F.when(model_id.contains("405b"), P99_LIMIT_405B)
        .when(model_id.contains("70b"), P99_LIMIT_70B)
        .otherwise(P99_LIMIT_DEFAULT)
    )


def slo_breached(model_id: Column, p99_ms: Column) -> Column:
    """NULL when there is no p99."""
    return p99_ms > p99_limit_ms(model_id)


def elapsed_hours(since: Column, as_of: datetime | None) -> Column:
    """Fractional hours from ``since`` to the reference instant, at microsecond resolution."""
    micros = F.unix_micros(as_of_column(as_of)) - F.unix_micros(since.cast("timestamp"))
    return micros / F.lit(1e6) / F.lit(3600.0)


def billable_hours(exit_code: Column, ended_at: Column, duration: Column, started_at: Column,
                   as_of: datetime | None) -> Column:
    """Platform faults are free; finished jobs bill their duration, running ones the time so far."""
    return (
        F.when(exit_code == EXIT_PLATFORM, 0.0)
        .when(ended_at.isNotNull(), duration)
        .otherwise(elapsed_hours(started_at, as_of))
    )


def job_cost(exit_code: Column, hours: Column, gpu_count: Column, price: Column) -> Column:
    """Cost of the billable hours; free after a platform fault even if the price is unknown."""
    return F.when(exit_code == EXIT_PLATFORM, 0.0).otherwise(
        round_half_away(hours * gpu_count * price, COST_DIGITS)
    )


def job_status(exit_code: Column, ended_at: Column) -> Column:
    return (
        F.when(ended_at.isNull(), "running")
        .when(exit_code == EXIT_OK, "succeeded")
        .when(exit_code == EXIT_OOM, "oom_killed")
        .when(exit_code == EXIT_PLATFORM, "platform_error")
        .otherwise("failed")
    )


def surrogate_key(columns: Sequence[str | Column], separator: str = KEY_FORMAT_LOCAL[0],
                  null_token: str = KEY_FORMAT_LOCAL[1]) -> Column:
    """MD5 over the text form of the columns, with NULLs made visible."""
    parts = (F.col(c) if isinstance(c, str) else c for c in columns)
    return F.md5(F.concat_ws(separator, *(F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts)))


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded share, NULL when the whole is zero."""
    return round_half_away(part.cast("double") / F.nullif(whole, F.lit(0)), digits)


def capacity_pressure(avg_util_pct: Column) -> Column:
    return F.when(avg_util_pct.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(avg_util_pct > 85, "high").when(avg_util_pct > 65, "medium").otherwise("low")
    )


def compliance_rate(breaches: Column, total: Column) -> Column:
    return round_half_away(F.lit(1.0) - breaches / F.greatest(total, F.lit(1)), 4)


def day_of_week(ts: Column) -> Column:
    """Sunday = 0."""
    return F.dayofweek(ts) - 1
