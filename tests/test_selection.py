"""Exact values at ranks against sorted lists."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenureframe import operators as op
from tenureframe.plans import quality

FRACTIONS = (0, 0.01, 0.25, 0.3, 0.5, 0.75, 0.99, 1)


def expected(values):
    found = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return [found[max(1, math.ceil(f * len(found))) - 1] if found else None for f in FRACTIONS]


def values_at(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    return op.values_at(df, "v", FRACTIONS).first()["values"]


RNG = random.Random(1)
EDGES = [sign * m * 2.0**e for sign in (1, -1) for m in (1, 1.5) for e in (-1074, -1022, -1, 0, 52, 1023)]
EDGES += [0.0, math.inf, -math.inf, math.nan, math.nextafter(1, 0), math.nextafter(8, 0), math.nextafter(8, 9)]
CASES = {
    "doubles": ("double", [RNG.uniform(-1e3, 1e3) for _ in range(300)] + [None]),
    "edges of doubles": ("double", EDGES),
    "no doubles": ("double", [None, None]),
    "longs": ("long", [RNG.randrange(-(2**63), 2**63) for _ in range(200)]),
    "few ints": ("int", [RNG.randrange(-4, 4) for _ in range(200)] + [None]),
    "one int": ("int", [7]),
    "decimals": ("decimal(10,2)", [Decimal(RNG.randrange(1 - 10**10, 10**10)) / 100 for _ in range(300)]),
    "dates": ("date", [dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(2000, 1, 1), None]),
    "no rows": ("long", []),
}


@pytest.mark.parametrize("name", CASES)
def test_values_are_those_of_the_sorted_list(spark, name):
    kind, values = CASES[name]
    found, wanted = values_at(spark, values, kind), expected(values)
    assert [str(v) if v != v else v for v in found] == [str(v) if v != v else v for v in wanted]


def test_a_million_distinct_values(spark):
    df = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).cast("decimal(12,2)").alias("v"))
    found = op.values_at(df, "v", (0.25, 0.5, 0.75)).first()["values"]
    disc = "percentile_disc({}) WITHIN GROUP (ORDER BY v)"
    assert found == list(df.selectExpr(*[disc.format(p) for p in (0.25, 0.5, 0.75)]).first())


def test_the_profile_holds_no_map_of_values(spark):
    df = spark.range(1000).select((F.col("id") * 3).cast("decimal(10,2)").alias("salary"))
    profile = quality.profile_out_of_range(df, "salary", 100, 200)
    plan = profile._jdf.queryExecution().toString()
    assert "percentile" not in plan
    outside = sorted(3 * i for i in range(1000) if not 100 <= 3 * i <= 200)
    row = profile.first()
    assert (row["count"], row["q50"]) == (len(outside), outside[math.ceil(0.5 * len(outside)) - 1])
    double = quality.profile_out_of_range(df.withColumn("salary", F.col("salary").cast("double")), "salary", 100, 200)
    assert double.first() == row and profile.columns == double.columns


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        op.values_at(spark.range(1).withColumn("v", F.lit("a")), "v", (0.5,))
