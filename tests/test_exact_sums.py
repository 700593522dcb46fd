"""Exact sums against rational arithmetic and under 20 random partitionings."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentlake.functions import exact_avg, mean_by
from incidentlake.functions.exact import LIMB_SUMS, WINDOW, digits_of, exact_sum, joined, limbs, merged_windows, parts, window_of, with_digits


def samples():
    rng = random.Random(12)
    any_double = lambda: math.ldexp(rng.uniform(-1, 1), rng.randint(-1074, 1000))
    groups = {
        "scores": [round(rng.uniform(0, 100), 7) for _ in range(400)],
        "tiny": [4e-7, 4e-7, 5e-324, 5e-324, -2.5e-310, 0.0, -0.0],
        "mixed": [any_double() for _ in range(300)],
        "cancel": [1e300, 1.0, -1e300, 3e-300, 2.0**61, -(2.0**61), 2.0**-30],
        "wide": [5e12, 0.1, -5e12, 37.1234567, 1e16, 1.0, -1e16],
        "powers": [math.ldexp(rng.choice((-1, 1)), e) for e in range(-1074, 1000, 7)],
        "edges": [math.nextafter(math.ldexp(1, 61 * w - 1074), d) for w in range(1, 34) for d in (0.0, math.inf)],
        "zeros": [-0.0, 0.0],
        "one": [0.1],
        "none": [None, None],
    }
    return [(k, v) for k, values in groups.items() for v in [*values, None]]


def expected(rows):
    total = {}
    for k, v in rows:
        total.setdefault(k, [])
        if v is not None:
            total[k].append(Fraction(v))
    return {k: float(sum(v)) if v else None for k, v in total.items()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(samples(), "k string, v double").cache()


def by_limbs(table):
    """The way of large tables: sums per group and window, then per group."""
    window = window_of(F.col("v"))
    rows = table.select("k", window.alias("w"), *(c.alias(n) for n, c in zip(LIMB_SUMS, limbs(*parts(F.col("v"), window)), strict=True)))
    first = rows.groupBy("k", "w").agg(*(F.sum(n).alias(n) for n in LIMB_SUMS))
    merged = with_digits(first.withColumnRenamed("w", WINDOW)).groupBy("k").agg(merged_windows().alias("s"))
    return merged.select("k", joined(digits_of(F.col("s"))).alias("v"))


def test_sums_are_exact(table):
    want = expected(samples())
    got = dict(table.groupBy("k").agg(exact_sum(F.col("v"))).collect())
    assert got == want
    assert dict(by_limbs(table).collect()) == want


def test_every_partitioning_gives_the_same_bits(spark, table):
    rng = random.Random(4)
    seen = set()
    for _ in range(20):
        dealt = table.withColumn("p", F.lit(rng.randrange(1000))).orderBy(F.xxhash64("v", "k", "p")).repartition(rng.randrange(1, 12))
        rows = sorted(mean_by(dealt, ["k"], "v", "a", {}, {}).collect())
        seen.add(tuple((r.k, None if r.a is None else r.a.hex()) for r in rows))
    rows = sorted(table.groupBy("k").agg(exact_avg("v").alias("a")).collect())
    seen.add(tuple((r.k, None if r.a is None else r.a.hex()) for r in rows))
    assert len(seen) == 1


def test_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", inf), ("a", 1.0), ("b", inf), ("b", -inf), ("c", nan), ("c", 2.0), ("d", -inf), ("d", -inf)]
    got = dict(spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_sum(F.col("v"))).collect())
    assert got["a"] == inf and got["d"] == -inf and math.isnan(got["b"]) and math.isnan(got["c"])


def test_many_rows_of_one_group(spark):
    rows = spark.range(300_000).select((F.rand(5) * 1e9 - 3e8).alias("v"), F.lit("k").alias("k"))
    values = [r.v for r in rows.collect()]
    assert by_limbs(rows).first()["v"] == math.fsum(values) == rows.agg(exact_sum(F.col("v"))).first()[0]
    assert np.sum(values) == pytest.approx(math.fsum(values))
