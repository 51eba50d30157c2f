"""Exact values at given ranks, by radix narrowing.

Values are mapped to whole numbers in the same order. A first histogram counts the
highest digits of all values; the digit in which a wanted rank lies is known from the
running counts, and the next histogram counts the next digits of the values that begin
with it, until all digits are known. A histogram has at most ``2 ** DIGIT_BITS`` bins for
each wanted rank, whatever the number of values, distinct ones included, and only
histograms are shuffled. Each one is a subquery that the next one asks: the plan is one,
and running it takes a scan for each digit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
)

from tenureframe.functions import row_count

DIGIT_BITS = 16

# Fixed values of floating numbers: bits of the fraction, and the exponent of one.
_FRACTION, _BIAS = 52, 1023
_WHOLE = {ByteType: 8, ShortType: 16, IntegerType: 32, LongType: 64, DateType: 32}


def _bits(kind: DataType) -> int:
    """Bits of the whole numbers that stand for a type's values, sign included."""
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return (10**kind.precision).bit_length() + 1
    if isinstance(kind, (FloatType, DoubleType)):
        return 64
    if type(kind) in _WHOLE:
        return _WHOLE[type(kind)]
    raise TypeError(f"ranks of {kind.simpleString()} are not known")


def _code(kind: DataType, column: Column) -> Column:
    """The whole number of a value; a larger value has a larger one. NaN is largest."""
    if isinstance(kind, DecimalType):
        return (column * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("long")
    if not isinstance(kind, (FloatType, DoubleType)):
        return column.cast("long")
    two, size = F.lit(2.0), F.abs(column.cast("double"))
    least = F.lit(1 - _BIAS)
    # The logarithm may be off by one beside a power of two.
    guess = F.greatest(F.floor(F.log2(F.when(size > 0, size))).cast("int"), least)
    exponent = (
        F.when((F.pow(two, guess) > size) & (guess > least), guess - 1)
        .when(F.pow(two, guess + 1) <= size, guess + 1)
        .otherwise(guess)
    )
    fraction = size / F.pow(two, exponent)
    normal = fraction >= 1
    digits = (F.when(normal, fraction - 1).otherwise(fraction) * F.lit(2.0**_FRACTION)).cast("long")
    biased = F.when(normal, exponent + _BIAS).otherwise(0).cast("long")
    bits = biased * F.lit(1 << _FRACTION) + digits
    endless = F.lit((2 * _BIAS + 1) << _FRACTION)
    bits = F.when(size == 0, F.lit(0)).when(size == float("inf"), endless).otherwise(bits)
    signed = F.when(column < 0, -bits).otherwise(bits)
    return F.when(F.isnan(column), endless + 1).otherwise(signed)


def _value(kind: DataType, code: Column) -> Column:
    """The value that a whole number stands for."""
    if isinstance(kind, DecimalType):
        return (code.cast("decimal(20,0)") / F.lit(10**kind.scale).cast("decimal(19,0)")).cast(kind)
    if isinstance(kind, DateType):
        return F.date_from_unix_date(code.cast("int"))
    if not isinstance(kind, (FloatType, DoubleType)):
        return code.cast(kind)
    bits, two = F.abs(code), F.lit(2.0)
    biased = F.shiftright(bits, _FRACTION)
    fraction = bits.bitwiseAND(F.lit((1 << _FRACTION) - 1)) / F.lit(2.0**_FRACTION)
    normal = (1 + fraction) * F.pow(two, biased - _BIAS)
    size = (
        F.when(biased == 0, fraction * F.pow(two, F.lit(1 - _BIAS)))
        .when(biased <= 2 * _BIAS, normal)
        .when(fraction == 0, F.lit(float("inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(code < 0, -size).when(code >= 0, size).cast(kind)


def values_at(
    df: DataFrame, column: str, fractions: Sequence[float], digit_bits: int = DIGIT_BITS
) -> DataFrame:
    """One row with ``values``, an array: the values of ``column`` at ``fractions`` of its rows.

    The value at a fraction is the smallest one that at least this share of the values
    does not exceed; 0 is the smallest value, 1 the largest. NULL values do not count;
    without values all are NULL. Zeros of either sign are one value, as Spark sorts them.
    """
    kind = df.schema[column].dataType
    codes = df.filter(F.col(column).isNotNull()).select(_code(kind, F.col(column)).alias("code"))
    shifts = list(range(0, _bits(kind), digit_bits))[::-1]
    asked, found = None, None
    alike = Window.partitionBy("begin")
    for step, shift in enumerate(shifts):
        if step == 0:
            begun = codes.withColumn("begin", F.lit(0).cast("long"))
        else:
            begun = codes.withColumn("begin", F.shiftright("code", shifts[step - 1])).filter(
                F.array_contains(asked["begins"], F.col("begin"))
            )
        counted = (
            begun.groupBy("begin", F.shiftright("code", shift).alias("digit"))
            .agg(row_count().alias("n"))
            .withColumn("upto", F.sum("n").over(alike.orderBy("digit")))
        )
        if step == 0:
            total = F.sum("n").over(alike)
            ranks = [F.greatest(F.ceil(total * float(f)), F.lit(1)).cast("long") for f in fractions]
            begins = F.array(*[F.lit(0).cast("long") for _ in fractions])
            counted = counted.withColumn("asked", F.struct(begins.alias("begins"), F.array(*ranks).alias("ranks")))
        else:
            # Each state is asked for twice in a step: the plan stays small.
            counted = counted.withColumn("asked", asked)
        places = [F.lit(at) for at in range(len(fractions))]

        def digit(at: Column) -> Column:
            rank = F.get("asked.ranks", at)
            here = (F.get("asked.begins", at) == F.col("begin")) & (F.col("upto") >= rank)
            left = (rank - F.col("upto") + F.col("n")).alias("rank")
            return F.min(F.when(here, F.struct("digit", left)))

        found = counted.agg(*[digit(at).alias(f"f{i}") for i, at in enumerate(places)])
        asked = found.select(
            F.struct(
                F.array(*[F.col(f"f{i}.digit") for i in range(len(places))]).alias("begins"),
                F.array(*[F.col(f"f{i}.rank") for i in range(len(places))]).alias("ranks"),
            )
        ).scalar()
    values = [_value(kind, F.col(f"f{i}.digit")) for i in range(len(fractions))]
    return found.select(F.array(*values).alias("values"))
