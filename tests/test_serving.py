import pytest

from thermalis.operators import serving as srv
from thermalis.plans import core_analysis, serving_views
from thermalis.schema import RESULTS, SERVED
from thermalis.sources import load_results, write_result

from conftest import rows_of


@pytest.fixture
def yearly(spark):
    return spark.createDataFrame([("a", 2001, 1.0), ("a", 2002, None), ("b", 2003, 3.0), ("b", 2004, 4.0)],
                                 "city string, year int, avg_uhi double")


def test_filter_uses_the_columns_that_exist(spark, yearly):
    assert srv.filter_result(yearly, ["b"], (2000, 2003)).count() == 1
    assert srv.filter_result(yearly, [], None).count() == 4
    decades = spark.createDataFrame([("a", "2000-2009")], "city string, decade string")
    assert srv.filter_result(decades, ["a"], (1900, 1901)).count() == 1
    assert srv.filter_result(spark.range(3), ["a"], (1, 2)).count() == 3
    texts = spark.createDataFrame([("a", "2001"), ("a", "2001.0"), ("a", "x"), ("a", None)], "city string, year string")
    assert srv.filter_result(texts, None, (2000, 2003)).count() == 2


def test_numeric_year_filter_reaches_the_scan(spark, yearly, tmp_path):
    yearly.write.parquet(str(tmp_path / "y"))
    plan = srv.filter_result(spark.read.parquet(str(tmp_path / "y")), ["a"], (2001, 2002))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(year,2001)" in plan and "EqualTo(city,a)" in plan


def test_heatmap_keeps_months_in_place(spark):
    monthly = spark.createDataFrame([("a", 2001, 1, 1.0), ("a", 2002, 1, 3.0), ("a", 2001, 12, 5.0)],
                                    "city string, year int, month int, avg_uhi double")
    got = srv.month_heatmap(monthly).first()
    assert (got.Jan, got.Feb, got.Nov, got.Dec) == (2.0, None, None, 5.0)


def test_history_and_forecast(spark, yearly):
    forecast = spark.createDataFrame([("a", "2025", "1.0"), ("a", "2025", "2.0"), ("b", "x", "1.0"), ("a", "2026", "?")],
                                     "city string, year string, predicted_uhi string")
    got = rows_of(srv.history_forecast(yearly, forecast, ["a"], (2001, 2001)), "city", "year", "uhi", "type")
    assert got == [("a", 2001, 1.0, "Historical"), ("a", 2025, 1.5, "Forecast")]
    assert srv.history_forecast(yearly, forecast.limit(0)).count() == 3


def test_alert_counts_without_severity(spark):
    alerts = spark.createDataFrame([("a", "CRITICAL"), ("a", "HIGH"), ("a", "MODERATE")], "city string, severity string")
    assert tuple(srv.alert_counts(alerts).first()) == (1, 1, 3)
    assert tuple(srv.alert_counts(alerts.drop("severity")).first()) == (0, 0, 3)


def test_map_points_use_known_cities(spark):
    ranks = spark.createDataFrame([("Pune", 0.5, 2.0, 30.0, 20.0), ("Kochi", -2.0, 1.0, 30.0, 20.0), ("X", 1.0, 1.0, 1.0, 1.0),
                                   ("Surat", 0.3, 1.005, 30.05, 20.0)],
                                  "city string, avg_uhi double, peak_uhi double, avg_urban_temp double, avg_night_temp double")
    got = {r.city: r for r in srv.map_points(ranks).collect()}
    assert set(got) == {"Pune", "Kochi", "Surat"}
    assert (got["Pune"].color, got["Pune"].radius, got["Pune"].lat, got["Pune"].lon) == ("red", 7.5, 18.58, 73.87)
    assert (got["Kochi"].color, got["Kochi"].radius) == ("blue", 30.0)
    assert (got["Surat"].color, got["Surat"].radius) == ("orange", 5.0)
    assert got["Surat"].popup == "Surat\nUHI: 0.30°C\nUrban: 30.1°C\nPeak: 1.01°C"


def test_options_and_range(spark, yearly):
    ranks = spark.createDataFrame([(c,) for c in "gfedcba"], "city string")
    got = srv.filter_options(ranks, yearly)
    assert rows_of(got.filter("preselected"), "value") == [(c,) for c in "abcde"]
    assert rows_of(got.filter("option = 'year'"), "place", "value") == [
        (1, "2001"), (2, "2002"), (3, "2003"), (4, "2004")]
    assert tuple(srv.year_range(yearly).first()) == (2001, 2004)
    assert tuple(srv.year_range(yearly.limit(0)).first()) == (2000, 2024)


def test_kpi_ties_go_to_the_first_name(spark):
    ranks = spark.createDataFrame([(c, 1.0, 20.0, None) for c in "ba"],
                                  "city string, avg_uhi double, avg_urban_temp double, avg_night_temp double")
    got = srv.kpis(ranks).first()
    assert (got.hottest_city, got.coolest_city, got.avg_urban_temp, got.avg_night_temp) == ("a", "a", 20.0, None)


def test_views_from_published_tables(spark, obs_of, tmp_path):
    obs = obs_of([(c, f"{y}-{m:02d}-01", 30.0, 29.0, 15.0, k + m / 10) for k, c in enumerate(("Pune", "Surat"))
                  for y in (2001, 2002) for m in (1, 5, 9)])
    for name, table in core_analysis(obs).items():
        write_result(table, str(tmp_path / name))
    loaded = load_results(spark, str(tmp_path))
    assert set(loaded) == set(SERVED)
    for key, table in loaded.items():
        assert table.columns == RESULTS[SERVED[key]].names
    assert loaded["forecast"].isEmpty() and loaded["yearly"].count() == 4
    views = serving_views(loaded, ["Pune"], (2001, 2001))
    counts = {name: view.count() for name, view in views.items()}
    assert counts == {"options": 4, "year_range": 1, "kpis": 1, "rankings": 2, "rates": 0, "yearly": 1, "moving_avg": 0,
                      "decade": 1, "map_points": 1, "month_heatmap": 1, "seasonal": 3, "temperatures": 1,
                      "peak_table": 0, "history_forecast": 1, "alert_counts": 1, "alerts": 0, "extreme": 0}


def test_first_rows_follow_the_order(spark):
    df = spark.range(1000, numPartitions=7)
    assert [r.id for r in srv.head_n(df, 3, "id").collect()] == [0, 1, 2]
    assert [r.id for r in srv.presented(df, "id", desc="id").limit(2).collect()] == [999, 998]
