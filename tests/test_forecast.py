import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from thermalis.operators import features as feat
from thermalis.operators import forecast as fc
from thermalis.plans import forecast_pipeline
from thermalis.sources import load_model, save_model

from conftest import rows_of


@pytest.fixture(scope="module")
def obs(obs_of):
    """Two cities with 24 full years, a third without night values in its last months."""
    rows = []
    for k, city in enumerate("abc"):
        for y in range(2001, 2025):
            for m in range(1, 13):
                uhi = k + math.sin(m / 2) + (y - 2000) * 0.05 * (k - 1)
                night = None if city == "c" and y == 2024 and m > 6 else 15.0 + m
                rows.append((city, f"{y}-{m:02d}-05", 30.0 + m + uhi, 30.0 + m, night, uhi))
    return obs_of(rows)


@pytest.fixture(scope="module")
def done(obs):
    return forecast_pipeline(obs)


def test_lags_go_by_row_and_start_at_zero(obs_of):
    rows = [("a", f"2003-{m:02d}-01", 1.0, 1.0, None, float(m)) for m in (1, 2, 5)]
    rows += [("a", f"2004-{m:02d}-01", 1.0, 1.0, None, float(10 * m)) for m in range(1, 12)]
    got = {(r.year, r.month): r for r in feat.monthly_features(obs_of(rows)).collect()}
    assert got[2003, 1].prev_month_uhi == 0 and got[2003, 5].prev_month_uhi == 2.0
    assert got[2004, 10].prev_year_uhi == 1.0 and got[2004, 9].prev_year_uhi == 0
    assert got[2003, 5].rolling_3m_uhi == pytest.approx(2.6667)
    free = {(r.year, r.month): r for r in feat.monthly_features(obs_of(rows), leak_free=True).collect()}
    assert free[2003, 5].rolling_3m_uhi == 1.5 and free[2003, 1].rolling_3m_uhi == 0


def test_split(obs):
    train, test = feat.time_split(feat.monthly_features(obs))
    assert (train.agg({"year": "max"}).first()[0], test.agg({"year": "min"}).first()[0]) == (2022, 2023)


def test_rows_without_night_value_are_skipped(done):
    assert done.results["test_predictions"].count() == 3 * 24 - 6


def test_metrics_match_the_evaluator(done):
    got = done.results["metrics"].first()
    for name in ("mae", "rmse", "r2"):
        want = RegressionEvaluator(labelCol="avg_uhi", predictionCol="prediction", metricName=name).evaluate(done.scored)
        assert got[name] == pytest.approx(want, abs=1e-4)
    assert got.r2 > 0.5


def test_forecast_covers_every_month(done):
    forecast = done.results["uhi_forecast_2025_2030"]
    assert forecast.count() == 3 * 6 * 12
    assert forecast.filter("predicted_uhi IS NULL OR isnan(predicted_uhi)").isEmpty()
    summary = done.results["forecast_summary"]
    assert summary.columns == ["city", "2025", "2026", "2027", "2028", "2029", "2030"] and summary.count() == 3


def test_importances_are_shares(done):
    rows = done.results["feature_importance"].collect()
    assert {r.feature for r in rows} == set(fc.FEATURES)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_layout_of_the_input_does_not_matter(obs, done):
    again = forecast_pipeline(obs.repartition(5, "month"))
    columns = "city", "year", "month", "predicted_uhi"
    name = "uhi_forecast_2025_2030"
    assert rows_of(again.results[name], *columns) == rows_of(done.results[name], *columns)


def test_saved_model_scores_alike(done, tmp_path):
    save_model(done.model, str(tmp_path / "m"))
    loaded = load_model(str(tmp_path / "m"))
    columns = "city", "year", "month", "prediction"
    test = done.scored.drop("city_index", "features", "prediction")
    assert rows_of(loaded.transform(test), *columns) == rows_of(done.scored, *columns)


def test_unknown_city(spark, done):
    row = ("new", 2025, 1, 3, 2, 30.0, 29.0, 15.0, 1.0, 1.0, 1.0, 0.0)
    columns = "city string, year int, month int, season int, decade int, " + ", ".join(
        f"{c} double" for c in (*fc.FEATURES[5:], "avg_uhi"))
    with pytest.raises(Exception):
        fc.forecast(done.model, spark.createDataFrame([row], columns)).collect()


def test_unknown_city_can_be_kept(spark, obs):
    features = feat.monthly_features(obs).filter("year < 2005")
    model = fc.fit_forecaster(features, keep_unknown=True, partitions=2)
    row = features.withColumn("city", features.city.substr(1, 0)).limit(1)
    assert fc.forecast(model, row).count() == 1


def test_more_cities_than_default_bins(obs_of):
    rows = [(f"c{i:02d}", f"200{y}-{m:02d}-01", 30.0 + i, 29.0, 15.0, float(i % 5)) for i in range(40)
            for y in (1, 2) for m in (1, 6)]
    features = feat.monthly_features(obs_of(rows))
    with pytest.raises(ValueError, match="needs 40 bins"):
        fc.fit_forecaster(features)
    model = fc.fit_forecaster(features, partitions=32, max_bins=64)
    assert len(model.stages[0].labels) == 40 and model.stages[-1].getMaxBins() == 64


def test_city_without_trend_and_month_without_history(spark, obs_of):
    obs = obs_of([("a", "2003-01-01", 20.0, 10.0, 5.0, 2.0), ("a", "2004-01-01", 22.0, 12.0, 5.0, 4.0)])
    trend = spark.createDataFrame([], "city string, slope_per_year double")
    got = {(r.year, r.month): r for r in fc.forecast_inputs(feat.monthly_features(obs), trend).collect()}
    assert got[2030, 1].prev_month_uhi == 3.0 and got[2030, 2].prev_month_uhi == 0.0
    assert (got[2025, 1].avg_urban_lst, got[2026, 1].avg_rural_lst, got[2030, 1].avg_night_lst) == (21.2, 11.3, 5.6)
    sloped = spark.createDataFrame([("a", 0.5)], trend.schema)
    moved = {(r.year, r.month): r for r in fc.forecast_inputs(feat.monthly_features(obs), sloped).collect()}
    assert (moved[2025, 1].prev_month_uhi, moved[2025, 1].prev_year_uhi, moved[2027, 2].rolling_3m_uhi) == (3.5, 3.0, 1.5)
