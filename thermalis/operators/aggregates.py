"""Grouped statistics, all derived from one month-level table of mergeable sums.

``cells`` scans the observations once. Every report accepts observations or such a cells table;
given settled cells, all reports together cost a single scan of the observations.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermalis.functions import decade_label, mean_of, rnd, season_label

CELL_KEYS = ["city", "year", "month"]
_SUMMED = {"uhi": "UHI_Index", "urban": "LST_Day_Urban", "rural": "LST_Day_Rural", "night": "LST_Night_Urban"}


def cells(obs: DataFrame) -> DataFrame:
    """Counts, sums, extremes and squared deviation per city, year and month."""
    sums = [agg(F.col(column)).alias(f"{prefix}_{name}")
            for name, column in _SUMMED.items()
            for prefix, agg in (("sum", F.sum), ("n", F.count))]
    return obs.groupBy(*CELL_KEYS).agg(
        F.count("*").alias("n_rows"),
        *sums,
        F.min("UHI_Index").alias("min_uhi"),
        F.max("UHI_Index").alias("max_uhi"),
        (F.var_pop("UHI_Index") * F.count("UHI_Index")).alias("dev_uhi"),
    )


def as_cells(source: DataFrame) -> DataFrame:
    return source if "n_rows" in source.columns else cells(source)


def merged(source: DataFrame, *keys) -> DataFrame:
    """Cells combined over coarser keys.

    The squared deviation of a union is the sum of those within the cells plus that of the cell
    means around the common mean.
    """
    n, total = F.col("n_uhi"), F.col("sum_uhi")
    between = F.sum(mean_of(total * total, n)) - mean_of(F.sum(total) * F.sum(total), F.sum(n))
    sums = [F.sum(f"{prefix}_{name}").alias(f"{prefix}_{name}") for name in _SUMMED for prefix in ("sum", "n")]
    return as_cells(source).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        *sums,
        F.min("min_uhi").alias("min_uhi"),
        F.max("max_uhi").alias("max_uhi"),
        F.greatest(F.sum("dev_uhi") + between, F.lit(0.0)).alias("dev_uhi"),
    )


def mean(measure: str, digits: int) -> Column:
    return rnd(mean_of(F.col(f"sum_{measure}"), F.col(f"n_{measure}")), digits)


def std_uhi() -> Column:
    """Sample standard deviation, null for a single value."""
    spread = F.when(F.col("n_uhi") > 1, F.sqrt(mean_of(F.col("dev_uhi"), F.col("n_uhi") - 1)))
    return rnd(spread, 4)


def _report(df: DataFrame, *columns) -> DataFrame:
    known = {
        "avg_uhi": mean("uhi", 4),
        "avg_urban_lst": mean("urban", 2),
        "avg_rural_lst": mean("rural", 2),
        "avg_night_lst": mean("night", 2),
        "std_uhi": std_uhi(),
        "min_uhi": rnd("min_uhi", 4),
        "max_uhi": rnd("max_uhi", 4),
        "observations": F.col("n_rows"),
        "obs": F.col("n_rows"),
    }
    return df.select(*[known[c].alias(c) if c in known else F.col(c) for c in columns])


def city_counts(source: DataFrame) -> DataFrame:
    """Records per city."""
    return merged(source, "city").select("city", F.col("n_rows").alias("count"))


def monthly(source: DataFrame) -> DataFrame:
    return _report(as_cells(source), "city", "year", "month", "avg_uhi", "avg_urban_lst", "avg_rural_lst",
                   "avg_night_lst", "min_uhi", "max_uhi", "observations")


def yearly(source: DataFrame) -> DataFrame:
    return _report(merged(source, "city", "year"), "city", "year", "avg_uhi", "avg_urban_lst",
                   "avg_rural_lst", "avg_night_lst", "std_uhi", "min_uhi", "max_uhi", "observations")


def seasonal(source: DataFrame) -> DataFrame:
    return _report(merged(source, "city", season_label().alias("season")), "city", "season", "avg_uhi",
                   "avg_urban_lst", "avg_rural_lst", "std_uhi", "observations")


def decade(source: DataFrame) -> DataFrame:
    return _report(merged(source, "city", decade_label().alias("decade")), "city", "decade", "avg_uhi",
                   "avg_urban_lst", "avg_rural_lst", "avg_night_lst", "std_uhi", "observations")


def rankings(source: DataFrame) -> DataFrame:
    """One row per city; ``presented(df, desc="avg_uhi")`` puts the hottest first."""
    return merged(source, "city").select(
        "city", mean("uhi", 4).alias("avg_uhi"), rnd("max_uhi", 4).alias("peak_uhi"),
        mean("urban", 2).alias("avg_urban_temp"), mean("night", 2).alias("avg_night_temp"),
        F.col("n_rows").alias("total_observations"),
    )


def yearly_base(source: DataFrame) -> DataFrame:
    """Rounded yearly means, the input of all temporal operators."""
    return _report(merged(source, "city", "year"), "city", "year", "avg_uhi", "avg_urban_lst", "obs")


def seasonal_decade(source: DataFrame) -> DataFrame:
    keys = season_label().alias("season"), decade_label().alias("decade")
    return _report(merged(source, "city", *keys), "city", "season", "decade", "avg_uhi", "avg_urban_lst", "obs")


def month_climatology(source: DataFrame) -> DataFrame:
    """Mean per city and calendar month over all years."""
    return _report(merged(source, "city", "month"), "city", "month", "avg_uhi")


def monthly_base(source: DataFrame) -> DataFrame:
    return _report(as_cells(source), "city", "year", "month", "avg_uhi", "avg_urban_lst", "avg_rural_lst",
                   "avg_night_lst")
