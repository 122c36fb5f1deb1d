import math
import random

import pytest
from pyspark.sql import functions as F

from thermalis import fixtures as fx
from thermalis.functions import rnd
from thermalis.operators import hotspots as hot
from thermalis.plans import hotspot_analysis

from conftest import rows_of


def year(city, values):
    return [(city, f"2003-{1 + i // 28:02d}-{1 + i % 28:02d}", v + 30, 30.0, None, v) for i, v in enumerate(values)]


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 100, 333])
def test_exact_thresholds_against_sorted_values(obs_of, n):
    random.seed(n)
    data = {c: [round(random.gauss(0, 4), random.choice([1, 6])) for _ in range(n)] for c in "ab"}
    got = {r.city: r for r in hot.thresholds(obs_of([x for c, v in data.items() for x in year(c, v)])).collect()}
    for city, values in data.items():
        ranked = sorted(values)
        for name, share in (("p50_uhi", 50), ("p75_uhi", 75), ("p90_uhi", 90), ("p95_uhi", 95)):
            assert got[city][name] == pytest.approx(ranked[math.ceil(n * share / 100) - 1], abs=5.1e-5)
        assert got[city].p90_urban_lst == pytest.approx(ranked[math.ceil(n * 90 / 100) - 1] + 30, abs=5.1e-3)


def test_exact_and_approximate_agree_on_small_cities(obs_of):
    random.seed(7)
    obs = obs_of(year("a", [random.uniform(-5, 5) for _ in range(300)]) + year("b", [1.5] * 40))
    columns = ["city", *hot.LEVELS]
    assert rows_of(hot.thresholds(obs), *columns) == rows_of(hot.thresholds(obs, exact=False), *columns)


def test_city_without_name_and_odd_values(obs_of):
    obs = obs_of(year(None, [1.0, 2.0]) + year("n", [float("nan"), 1.0]) + year("big", [-1e12, 1e12]))
    got = {r.city: r for r in hot.thresholds(obs).collect()}
    assert got[None].p50_uhi == 1.0 and got["big"].p95_uhi == 1e12
    assert math.isnan(got["n"].p95_uhi) and got["n"].p50_uhi == 1.0
    assert {r.city for r in hot.hotspots(obs).collect()} <= {"n", "big"}


def test_value_equal_to_the_threshold_is_no_hotspot(obs_of):
    obs = obs_of(year("a", [float(v) for v in range(1, 11)]))
    assert rows_of(hot.hotspots(obs), "uhi_index", "threshold_p90", "severity") == [(10.0, 9.0, "MODERATE")]


def test_negative_threshold_makes_every_hotspot_critical(obs_of):
    obs = obs_of(year("a", [-20.0 + v for v in range(20)]))
    got = hot.hotspots(obs).collect()
    assert got and {r.severity for r in got} == {"CRITICAL"} and got[0].threshold_p90 < 0


def test_reports_of_alerts(obs_of):
    obs = obs_of(year("a", [0.0] * 18 + [3.0, 9.0]) + year("b", [1.0] * 9 + [1.3]))
    results = reports = hotspot_analysis(obs)
    assert rows_of(reports["hotspot_summary"], "city", "severity", "event_count", "avg_uhi", "avg_temp") == [
        ("a", "CRITICAL", 2, 6.0, 36.0), ("b", "HIGH", 1, 1.3, 31.3)]
    assert rows_of(reports["monthly_hotspot_freq"], "city", "month", "hotspot_count") == [("a", 1, 2), ("b", 1, 1)]
    assert results["extreme_heat_events"].isEmpty()


def test_top_events_break_ties_by_date(obs_of):
    obs = obs_of(year("a", [1.0] * 12 + [2.0]) + [("a", "2009-01-01", 1.0, 1.0, 1.0, float("-inf"))])
    got = sorted(hot.top_events(obs, 3).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r.UHI_Index, r.date.day) for r in got] == [(1, 2.0, 13), (2, 1.0, 1), (3, 1.0, 2)]


def test_extreme_heat_is_strict(obs_of):
    obs = obs_of([("a", "2003-01-01", 45.0, 1.0, None, 1.0), ("a", "2003-01-02", 45.01, 1.0, None, 1.0)])
    assert [r.LST_Day_Urban for r in hot.extreme_heat(obs).collect()] == [45.01]


@pytest.mark.parametrize("k", [1, 3, 10, 50])
def test_floors_do_not_change_the_top_events(obs_of, k):
    random.seed(k)
    rows = [(c, f"{y}-{m:02d}-{d:02d}", float(d), 1.0, None, round(random.gauss(0, 2), 1))
            for c in ("a", "b", None) for y in (2003, 2004) for m in range(1, 13) for d in (1, 2, 3, 4)]
    rows += year("few", [5.0, 4.0]) + [("few", "2004-01-01", 1.0, 1.0, 1.0, None)]
    rows += year("nan", [float("nan")] * 3 + [1.0] * 60)
    obs = obs_of(rows)
    no_floors = hot.event_floors(obs, k).limit(0)
    plain, pruned = hot.top_events(obs, k, no_floors), hot.top_events(obs, k)
    assert plain.columns == pruned.columns
    assert plain.exceptAll(pruned).isEmpty() and pruned.exceptAll(plain).isEmpty()


def test_sketches_merge_over_months_and_leave_out_what_is_missing(obs_of):
    obs = obs_of(year("a", [float(v) for v in range(200)]) + [("none", "2003-01-01", None, None, None, None)])
    got = {r.city: r for r in hot.thresholds(obs, exact=False).collect()}
    assert got["a"].p50_uhi == 99.0 and got["a"].p95_urban_lst == 219.0 and got["none"].p90_uhi is None
    ranks = {(r.city, r.level): r.error for r in hot.threshold_ranks(obs, hot.thresholds(obs, exact=False)).collect()}
    assert ranks["a", "p90_uhi"] == 0 and ranks["none", "p90_uhi"] is None


def test_approximate_thresholds_are_near_the_rank(spark):
    obs = fx.obs(spark, "/root/testdata/sf0.01").select("city", "year", "month", rnd("UHI_Index", 4).alias("v"), "LST_Day_Urban")
    limits = hot.thresholds(obs.withColumnRenamed("v", "UHI_Index"), exact=False)
    ranks = obs.join(limits, "city").groupBy("city").agg(
        F.count("*").alias("n"), *[f(F.when(c(F.col("v"), F.col(name)), 1)).alias(f"{name}_{side}")
                                   for name in ("p50_uhi", "p75_uhi", "p90_uhi", "p95_uhi") for side, f, c in (
                                       ("below", F.count, lambda v, t: v < t), ("upto", F.count, lambda v, t: v <= t))])
    for r in ranks.collect():
        for share in (50, 75, 90, 95):
            position = math.ceil(r.n * share / 100)
            assert r[f"p{share}_uhi_below"] - 5 <= position <= r[f"p{share}_uhi_upto"] + 5
