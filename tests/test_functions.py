import math
import random

from pyspark.sql import functions as F

from thermalis.functions import month_name, rnd, rnd_rows, season_code, season_label, decade_code, decade_label


def test_rounding(spark):
    values = [19.525, 2.5, -2.5, 0.1 + 0.2, float("nan"), float("inf"), 1e35, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(rnd("v", 2)).collect()]
    assert got[:4] == [19.53, 2.5, -2.5, 0.3]
    assert math.isnan(got[4]) and got[5:] == [float("inf"), 1e35, None]


def test_noise_does_not_move_a_tie(spark):
    df = spark.createDataFrame([(19.525,), (19.524999999999999,), (19.525000000000002,)], "v double")
    assert {r[0] for r in df.select(rnd("v", 2)).collect()} == {19.53}


def test_null_and_outside_values_take_the_last_label(spark):
    df = spark.createDataFrame([(None, None), (1, 1999), (12, 2025), (3, 2009)], "month int, year int")
    got = [tuple(r) for r in df.select(season_label(), season_code(), decade_label(), decade_code()).collect()]
    last = ("Winter", 3, "2020-2024", 2)
    assert got == [last, last, last, ("Pre-Monsoon", 0, "2000-2009", 0)]


def test_month_name(spark):
    df = spark.createDataFrame([(1,), (12,), (13,), (None,)], "m int")
    assert [r[0] for r in df.select(month_name(F.col("m"))).collect()] == ["Jan", "Dec", None, None]


def test_quick_rounding_equals_the_decimal(spark):
    random.seed(1)
    values = [random.uniform(-60, 60) for _ in range(20000)]
    values += [s * (k + 0.5) / 10 ** d for k in range(3000) for d in (2, 4) for s in (1, -1)]
    values += [v + e for v in (19.525, -0.00005, 3.12345) for e in (1e-15, -1e-15, 1e-11, -1e-11, 1e-9, -1e-9, 1e-8, -1e-8)]
    values += [0.0, -0.0, -1e-7, 99999.99995, 1e5, -1e5 + 1e-5, 1e16, 1e300, -1e300, float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4):
        assert df.filter(~rnd("v", digits).eqNullSafe(rnd_rows("v", digits))).isEmpty()
