import statistics

import pytest

from thermalis.operators import aggregates as agg
from thermalis.plans import core_analysis, temporal_analysis

from conftest import rows_of


def test_single_value_has_no_spread(obs_of):
    obs = obs_of([("a", "2003-01-01", 1.0, 2.0, None, 3.0)])
    got = agg.yearly(obs).first()
    assert got.std_uhi is None and got.avg_night_lst is None and got.observations == 1


def test_constant_values_have_zero_spread(obs_of):
    obs = obs_of([("a", f"2003-{m:02d}-01", 1.0, 2.0, None, 0.3) for m in range(1, 13)])
    assert agg.yearly(obs).first().std_uhi == 0.0


def test_spread_is_pooled_over_months(obs_of):
    values = [float(v) for v in (1, 5, 2, 8, 3, 13, -4, 7, 100)]
    obs = obs_of([("a", f"2003-{1 + i % 4:02d}-{i + 1:02d}", 1.0, 2.0, None, v) for i, v in enumerate(values)])
    assert agg.yearly(obs).first().std_uhi == pytest.approx(statistics.stdev(values), abs=1e-4)


def test_cells_and_observations_give_the_same_reports(spark, obs_of):
    obs = obs_of([(c, f"{y}-{m:02d}-{d:02d}", 20.0 + m + d, 15.0 + y % 7, None if m == 2 else 10.0 + d, (m * d) % 5 - 1.5)
                  for c in "ab" for y in range(2001, 2008) for m in (1, 2, 7) for d in (1, 9)])
    cells = agg.cells(obs)
    from_cells = {**core_analysis(cells), **temporal_analysis(cells)}
    for name, table in {**core_analysis(obs), **temporal_analysis(obs)}.items():
        assert table.exceptAll(from_cells[name]).isEmpty() and table.count() == from_cells[name].count(), name


def test_bad_dates_form_their_own_group(obs_of):
    obs = obs_of([("a", None, 1.0, 2.0, 3.0, 4.0), ("a", "2003-06-01", 1.0, 2.0, 3.0, 4.0)])
    assert rows_of(agg.seasonal(obs), "season") == [("Monsoon",), ("Winter",)]
    assert {r.year for r in agg.yearly(obs).collect()} == {None, 2003}


def test_nan_reaches_the_mean(obs_of):
    obs = obs_of([("a", "2003-06-01", float("nan"), 2.0, 3.0, 4.0), ("a", "2003-06-02", 1.0, 2.0, 3.0, 6.0)])
    got = agg.monthly(obs).first()
    assert got.avg_urban_lst != got.avg_urban_lst and got.avg_uhi == 5.0
