"""Column-expression helpers against plain Python arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from entiscore.functions import measures as M


def h2(n):
    return math.fsum(1.0 / (k * k) for k in range(1, n + 1))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 255, 256, 257, 1000, 20000])
def test_inverse_square_sum(spark, n):
    got = spark.range(1).select(F.lit(n).alias("n")).select(M.inverse_square_sum("n").alias("v")).first()["v"]
    assert got == pytest.approx(h2(n), abs=1e-13)


def test_inverse_square_sum_huge_n(spark):
    got = spark.range(1).select(F.lit(10**9).alias("n")).select(M.inverse_square_sum("n").alias("v")).first()["v"]
    assert got == pytest.approx(math.pi ** 2 / 6 - 1e-9, abs=1e-13)


def test_rank_weighted_sum_matches_expanded_list(spark):
    groups = [(1.0, 3), (0.75, 2), (0.25, 500), (0.0, 4)]
    expanded = [s for s, n in groups for _ in range(n)]
    want = math.fsum(s / (i + 1) ** 2 for i, s in enumerate(expanded))
    df = spark.createDataFrame([([{"score": s, "n": n} for s, n in groups],)], "g array<struct<score:double,n:long>>")
    r = df.select(M.rank_weighted_sum("g").alias("r")).first()["r"]
    assert r["hs"] == pytest.approx(want, abs=1e-12) and r["n"] == len(expanded)


@pytest.mark.parametrize("x,want", [(-0.2, "-1"), (-0.1, None), (-0.0999999, "0"), (0.05, "0"),
                                    (0.0999999, "0"), (0.09999995, None), (0.1, None), (0.2, "1"), (None, None)])
def test_bands(spark, x, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(M.bands(F.col("x"), -0.1, 0.1, -0.0999999, 0.0999999).alias("b")).first()["b"] == want


def test_category_score_unknown_is_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    got = [r[0] for r in df.select(M.category_score("x", [("a", 1.0), ("b", None)])).collect()]
    assert got == [1.0, None, None, None]


def test_ramp_no_negative_zero(spark):
    df = spark.createDataFrame([(60.0,)], "x double")
    v = df.select(M.ramp(F.col("x"), 60.0, 100.0, sign=-1.0)).first()[0]
    assert v == 0.0 and math.copysign(1.0, v) == 1.0


def test_minmax_scaled_zero_range_is_null(spark):
    df = spark.createDataFrame([(5, 5, 5), (5, 0, 10)], "x int, lo int, hi int")
    assert [r[0] for r in df.select(M.minmax_scaled("x", "lo", "hi")).collect()] == [None, 0.0]
