import numpy as np
import pytest

from thermalis.operators import temporal as tmp

from conftest import rows_of


def base(spark, rows):
    return spark.createDataFrame(rows, "city string, year int, avg_uhi double")


def test_change_goes_by_row(spark):
    got = tmp.yoy(base(spark, [("a", 2001, 1.0), ("a", 2004, 1.2), ("a", 2005, 1.1), ("a", 2006, 1.0), ("b", 2001, 5.0)]))
    assert [tuple(r) for r in got.orderBy("city", "year").select("prev_year_uhi", "yoy_change", "trend").collect()] == [
        (None, None, "→ Stable"), (1.0, 0.2, "↑ Increasing"), (1.2, -0.1, "→ Stable"), (1.1, -0.1, "→ Stable"),
        (None, None, "→ Stable")]


def test_trend_needs_five_years_and_survives_a_constant(spark):
    rows = [("few", 2000 + i, float(i)) for i in range(4)] + [("flat", 2000 + i, 0.3) for i in range(6)]
    rows += [("null", 2000 + i, None if i == 0 else 1.0) for i in range(5)]
    rows += [(None, 2000 + i, float(i)) for i in range(6)]
    got = tmp.trend_rate(base(spark, rows)).collect()
    assert [(r.city, r.slope_per_year, r.r_squared, r.trend) for r in got] == [("flat", 0.0, 0.0, "Cooling")]


def test_trend_is_least_squares(spark):
    years, values = [2001, 2002, 2004, 2007, 2009, 2010], [0.1, 0.5, 0.2, 0.9, 0.7, 1.4]
    got = tmp.trend_rate(base(spark, [("a", y, v) for y, v in zip(years, values)])).first()
    slope, _ = np.polyfit(years, values, 1)
    assert got.slope_per_year == pytest.approx(slope, abs=1e-6)
    assert got.rate_per_decade_c == pytest.approx(slope * 10, abs=1e-4)
    assert got.r_squared == pytest.approx(np.corrcoef(years, values)[0, 1] ** 2, abs=1e-4)
    assert (got.first_year_uhi, got.last_year_uhi, got.overall_change, got.trend) == (0.1, 1.4, 1.3, "Warming")


def test_moving_average_is_partial_at_the_start(spark):
    got = tmp.moving_avg(base(spark, [("a", 2000 + i, float(i)) for i in range(7)]))
    assert [r[1] for r in rows_of(got, "year", "moving_avg_5yr")] == [0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0]


def test_lower_month_wins_a_tie(obs_of):
    obs = obs_of([("a", "2003-07-01", 1.0, 1.0, None, 4.0), ("a", "2003-05-01", 1.0, 1.0, None, 4.0),
                  ("a", "2003-06-01", 1.0, 1.0, None, 3.0)])
    assert rows_of(tmp.peak_month(obs), "city", "peak_month", "peak_uhi") == [("a", 5, 4.0)]
