import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from loanlens.functions.numbers import avg_score, fixed_text, float_text, round_half_even_exact, round_half_up, sum_money


def test_exact_rounding_agrees_with_correct_rounding(spark):
    draw = random.Random(5)
    values = [0.0625, 0.0025, 0.0015, 2.675, 2.125, 1.005, 0.285, -1.625, 5.0005, 100.0, 1 / 3]
    values += [100 * n / d for n, d in ((draw.randrange(1, 4000), draw.randrange(1, 4000)) for _ in range(3000))]
    values += [k / 1000 + 0.0005 for k in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", round_half_even_exact("x", 3).alias("r3"), round_half_even_exact("x", 2).alias("r2")).collect()
    for r in got:
        assert r["r3"] == round(r["x"], 3) and r["r2"] == round(r["x"], 2), r


def test_half_up_rounds_the_scaled_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()] == [1.0, 2.68, 0.13, -0.13]


def test_text_of_numbers(spark):
    df = spark.createDataFrame([(47.94,), (12.5,), (3.0,), (12345678.9,), (0.0,)], "x double")
    assert [r[0] for r in df.select(float_text(F.col("x"), 2)).collect()] == ["47.94", "12.5", "3.0", "12345678.9", "0.0"]
    assert [r[0] for r in df.select(fixed_text("x", 2)).collect()][1:3] == ["12.50", "3.00"]


def test_aggregates_are_exact_and_skip_missing_values(spark):
    draw = random.Random(3)
    cents = [draw.randrange(10**9) for _ in range(2000)]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "x double").repartition(7)
    got = df.agg(sum_money(F.col("x")), avg_score(F.col("x"))).first()
    assert got[0] == sum(cents) / 100
    assert got[1] == float(Fraction(sum(cents), 100 * len(cents))) or abs(got[1] - sum(cents) / 100 / len(cents)) < 1e-9
    assert df.filter("x IS NULL").agg(avg_score(F.col("x"))).first()[0] is None


def test_sums_keep_what_lies_beyond_two_decimals(spark):
    many = spark.range(1000).selectExpr("1.004D AS x")
    assert many.agg(sum_money(F.col("x"))).first()[0] == 1004.0
    assert many.selectExpr("0.00004D AS x").agg(avg_score(F.col("x"))).first()[0] == 0.00004
    draw = random.Random(9)
    values = [round(draw.uniform(-1e7, 1e7), draw.randrange(8)) for _ in range(3000)]
    got = spark.createDataFrame([(v,) for v in values], "x double").repartition(5).agg(sum_money(F.col("x"))).first()[0]
    assert abs(got - math.fsum(values)) < 1e-6
