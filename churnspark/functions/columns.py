"""Column expressions used across operators. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def in_range_or_null(x: Column, low: float, high: float) -> Column:
    return F.when(x.between(low, high), x)


def to_double(x: Column) -> Column:
    """Numeric value of anything, NULL when it has none."""
    return x.try_cast("double")


def is_missing(x: Column, kind: str | T.DataType) -> Column:
    """NULL and NaN are the same missing value."""
    name = kind if isinstance(kind, str) else kind.simpleString()
    return x.isNull() | F.isnan(x) if name in ("double", "float") else x.isNull()


def finite_or_zero(x: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL unless den > 0."""
    return F.when(den > 0, num / den)


def ratio0(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0."""
    return F.when(den != 0, num / den).otherwise(0.0)


def clamp(x: Column, low: float, high: float) -> Column:
    """x forced into [low, high]; a missing x (NULL, NaN) stays missing."""
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def half_up(x: Column, digits: int = 0) -> Column:
    """floor(x * 10^d + 0.5) / 10^d."""
    scale = 10.0 ** digits
    return F.floor(x * scale + 0.5) / scale


def half_up_int(x: Column) -> Column:
    return F.floor(x + 0.5).cast("bigint")


def hash_fraction(key: Column, seed: int | str) -> Column:
    """Uniform number in [0, 1) that depends only on the key and the seed, so it survives any repartitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2 ** 52)


def order_code(x: Column) -> Column:
    """A long that orders like the double: sign, exponent and mantissa as one number. 0 and -0 are 0; NaN has no code."""
    a = F.abs(x)
    guess = F.floor(F.log2(a))  # may be off by one next to a power of two
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + (a >= 2 * power).cast("bigint") - (a < power).cast("bigint")
    mantissa = (a / F.pow(F.lit(2.0), exponent) - 1) * float(2 ** 52)
    normal = (exponent + 1023) * F.lit(2 ** 52) + mantissa.cast("bigint")
    size = (F.when(F.isnan(x), None).when(a == 0, 0).when(a == float("inf"), 2047 * 2 ** 52)
            .when(a < 2.0 ** -1022, (a * 2.0 ** 537 * 2.0 ** 537).cast("bigint")).otherwise(normal))
    return F.when(x < 0, -size).otherwise(size).cast("bigint")


def step_bucket(score: Column, steps: int) -> Column:
    """How many of the thresholds 1/steps, 2/steps ... (steps-1)/steps the score reaches.

    floor(score * steps) is off by at most one near a threshold; the two comparisons put it right.
    """
    guess = F.floor(clamp(score, 0.0, 1.0) * steps).cast("int")
    up = (score >= (guess + 1) / float(steps)).cast("int")
    down = (score < guess / float(steps)).cast("int")
    return F.when(score.isNull() | F.isnan(score), 0).otherwise(
        F.greatest(F.least(guess + up - down, F.lit(steps - 1)), F.lit(0))
    )


def sorted_bucket(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending ``cuts`` are <= x, as a balanced decision expression (log2 comparisons per row)."""
    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(x >= F.lit(float(cuts[middle])), pick(middle + 1, high)).otherwise(pick(low, middle))

    return pick(0, len(cuts))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, Abramowitz-Stegun 26.2.17 (absolute error below 1e-7)."""
    # The coefficients of the published approximation.
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (b[0] + t * (b[1] + t * (b[2] + t * (b[3] + t * b[4]))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
