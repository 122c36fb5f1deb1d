"""Percentile thresholds, heat alerts and top events."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermalis.functions import mean_of, rnd, rnd_rows, severity
from thermalis.functions.fixed import EXTREME_HEAT_C
from thermalis.operators.aggregates import as_cells
from thermalis.sources.durable import settle

MEASURED = UHI, URBAN = "UHI_Index", "LST_Day_Urban"

# Stands for a null city in join keys.
NO_CITY = "\u0000"

#: Size of the percentile sketches (their ranks are off by about 2.3 / k ** 0.9), and tasks that share a hot city or month.
SKETCH_K, SALTS = 4096, 16

# Output column -> (measure, share in ten-thousandths, digits).
LEVELS = {
    "p50_uhi": (UHI, 5000, 4),
    "p75_uhi": (UHI, 7500, 4),
    "p90_uhi": (UHI, 9000, 4),
    "p95_uhi": (UHI, 9500, 4),
    "p90_urban_lst": (URBAN, 9000, 2),
    "p95_urban_lst": (URBAN, 9500, 2),
}


def thresholds(obs: DataFrame, exact: bool = True, k: int = SKETCH_K, targets: DataFrame | None = None) -> DataFrame:
    """Rounded percentiles per city (the smallest value that covers the share).

    The exact form reads the observations twice, shuffles only counts and has no hot task. Its
    first reading, ``threshold_targets``, is settled here unless given. The approximate form reads once and merges
    the sketches of ``measure_sketches``.
    """
    if not exact:
        return sketched_thresholds(measure_sketches(obs, k), k)
    return _values_at(obs, settle(threshold_targets(obs), "targets") if targets is None else targets)


def measure_sketches(obs: DataFrame, k: int = SKETCH_K, salts: int = SALTS) -> DataFrame:
    """KLL sketches of both measures per city, year and month; they merge into those of any longer span.

    The sketches that the tasks of the reading make are merged by salts first, so that no task merges those of a hot
    month alone. Nulls and NaN are left out.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")
    parts = obs.groupBy("city", "year", "month", salt).agg(*[F.kll_sketch_agg_double(m, k).alias(m) for m in MEASURED])
    return parts.groupBy("city", "year", "month").agg(*[F.kll_merge_agg_double(m, k).alias(m) for m in MEASURED])


def sketched_thresholds(sketches: DataFrame, k: int = SKETCH_K, rounded: bool = True) -> DataFrame:
    """Percentiles per city from its months' sketches; a measure without values has none."""
    whole = sketches.groupBy("city").agg(*[F.kll_merge_agg_double(m, k).alias(m) for m in MEASURED])

    def level(measure, share, digits):
        value = F.when(F.kll_sketch_get_n_double(measure) > 0, F.kll_sketch_get_quantile_double(measure, F.lit(share / 10000)))
        return rnd(value, digits) if rounded else value

    return whole.select("city", *[level(*of).alias(name) for name, of in LEVELS.items()])


def threshold_ranks(obs: DataFrame, limits: DataFrame) -> DataFrame:
    """city, level, n, wanted, error: how far each limit's rank is from the wanted one, as a share of the city's n values.

    Limits are not rounded. Any rank that equal values share counts.
    """
    rows = obs.join(limits, "city")
    counts = rows.groupBy("city").agg(*[agg.alias(f"{kind}_{name}") for name, (m, _, _) in LEVELS.items() for kind, agg in (
        ("n", F.count(m)), ("below", F.count_if(F.col(m) < F.col(name))), ("upto", F.count_if(F.col(m) <= F.col(name))))])
    each = F.array(*[F.struct(F.lit(name).alias("level"), F.lit(share).alias("share"), *[F.col(f"{kind}_{name}").alias(kind) for kind in ("n", "below", "upto")])
                     for name, (_, share, _) in LEVELS.items()])
    wanted = F.expr("(n * share + 9999) div 10000")
    off = F.greatest(F.col("below") + 1 - F.col("wanted"), F.col("wanted") - F.col("upto"), F.lit(0))
    return (counts.select("city", F.inline(each)).withColumn("wanted", wanted)
            .select("city", "level", "n", "wanted", F.try_divide(off, "n").alias("error")))


def _bin(value):
    """The value's bin of 0.1 °C. Values beyond the range of the bins share the first or last, NaN the last."""
    return F.when(F.isnan(value), F.lit(2 ** 63 - 1)).otherwise(F.floor(value * 10))


def _by_measure(obs):
    """One row per observation and measure (by number), with the value's bin."""
    pairs = F.array(*[F.struct(F.lit(i).alias("measure"), F.col(m).alias("value")) for i, m in enumerate(MEASURED)])
    rows = (obs.select(F.coalesce("city", F.lit(NO_CITY)).alias("key"), F.inline(pairs))
            .filter(F.col("value").isNotNull()))
    return rows.withColumn("bin", _bin(F.col("value")))


def threshold_targets(obs: DataFrame) -> DataFrame:
    """The bins that hold a wanted percentile, with its position among the values of the bin.

    Counts per bin are few, whatever the number of observations, and a hot city is counted on the map
    side. The result has at most one row per city and percentile.
    """
    counts = _by_measure(obs).groupBy("key", "measure", "bin").agg(F.count("*").alias("n"))
    city = Window.partitionBy("key", "measure")
    upto = F.sum("n").over(city.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    levels = F.array(*[
        F.struct(F.lit(name).alias("level"), F.lit(MEASURED.index(m)).alias("of"), F.lit(share).alias("share"))
        for name, (m, share, _) in LEVELS.items()])
    # The position of a share among all values, counted from the start of the bin.
    wanted = (counts.withColumns({"before": upto - F.col("n"), "total": F.sum("n").over(city)})
              .withColumn("want", F.explode(levels)).filter(F.col("want.of") == F.col("measure"))
              .withColumn("position", F.expr("(total * want.share + 9999) div 10000") - F.col("before"))
              .filter((F.col("position") > 0) & (F.col("position") <= F.col("n"))))
    return wanted.groupBy("key", "measure", "bin").agg(
        F.collect_list(F.struct(F.col("want.level").alias("level"), "position")).alias("wanted"))


def _values_at(obs, targets):
    """The rounded values at the target positions.

    Only values in a target bin are counted, by their rounded value: rounding keeps the order, so
    the rounded percentile is a percentile of the rounded values, of which a bin has at most 1000. A city's rows are
    dealt over SALTS tasks where the targets are too large to broadcast, and are doubled only if both values count.
    """
    keys = "key", "measure", "bin"
    bins = targets.groupBy("key").agg(*[F.collect_set(F.when(F.col("measure") == i, F.col("bin"))).alias(f"bins_{i}") for i in range(len(MEASURED))])
    bins = bins.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*MEASURED), F.lit(SALTS)).cast("int")
    rows = obs.select(F.coalesce("city", F.lit(NO_CITY)).alias("key"), salt.alias("salt"), *MEASURED).join(bins, ["key", "salt"])

    def hit(i, digits):
        value = F.col(MEASURED[i])
        return F.when(F.array_contains(f"bins_{i}", _bin(value)),
                      F.struct(F.lit(i).alias("measure"), _bin(value).alias("bin"), rnd_rows(value, digits).alias("value")))

    hits = rows.select("key", F.inline(F.array_compact(F.array(hit(0, 4), hit(1, 2)))))
    counts = hits.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (counts.withColumn("upto", F.sum("n").over(order))
             .join(targets, list(keys)).select("key", "value", "n", "upto", F.inline("wanted"))
             .filter((F.col("position") <= F.col("upto")) & (F.col("position") > F.col("upto") - F.col("n"))))
    wide = found.groupBy("key").agg(*[
        F.max(F.when(F.col("level") == name, F.col("value"))).alias(name) for name in LEVELS])
    return wide.select(F.nullif("key", F.lit(NO_CITY)).alias("city"), *LEVELS)


def with_thresholds(obs: DataFrame, limits: DataFrame) -> DataFrame:
    """Observations of cities that have thresholds, with the 90th percentiles attached.

    Give settled thresholds: Catalyst then knows their size and broadcasts them if small enough.
    """
    return obs.join(limits.select("city", "p90_uhi", "p90_urban_lst"), "city")


def hotspots(obs: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Observations strictly above their city's 90th percentile, with a severity."""
    limits = settle(thresholds(obs), "thresholds") if limits is None else limits
    return (with_thresholds(obs, limits)
            .filter(F.col(UHI) > F.col("p90_uhi"))
            .select("city", "date", "year", "month",
                    rnd_rows(URBAN, 2).alias("urban_temp_c"), rnd_rows("LST_Day_Rural", 2).alias("rural_temp_c"),
                    rnd_rows(UHI, 4).alias("uhi_index"), F.col("p90_uhi").alias("threshold_p90"),
                    severity(F.col(UHI), F.col("p90_uhi")).alias("severity")))


def hotspot_cells(alerts: DataFrame) -> DataFrame:
    """Mergeable sums per city, severity and month, for the two alert reports."""
    if "n_alerts" in alerts.columns:
        return alerts
    return alerts.groupBy("city", "severity", "month").agg(
        F.count("*").alias("n_alerts"),
        F.sum("uhi_index").alias("sum_uhi"), F.count("uhi_index").alias("n_uhi"),
        F.sum("urban_temp_c").alias("sum_temp"), F.count("urban_temp_c").alias("n_temp"))


def _pooled(alerts, *keys):
    sums = ["n_alerts", "sum_uhi", "n_uhi", "sum_temp", "n_temp"]
    return hotspot_cells(alerts).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def hotspot_summary(alerts: DataFrame) -> DataFrame:
    """Alerts per city and severity; means are taken over the rounded values."""
    return _pooled(alerts, "city", "severity").select(
        "city", "severity", F.col("n_alerts").alias("event_count"),
        rnd(mean_of(F.col("sum_uhi"), F.col("n_uhi")), 4).alias("avg_uhi"),
        rnd(mean_of(F.col("sum_temp"), F.col("n_temp")), 2).alias("avg_temp"))


def hotspot_monthly(alerts: DataFrame) -> DataFrame:
    """Alerts per city and calendar month, all years pooled."""
    return _pooled(alerts, "city", "month").select(
        "city", "month", F.col("n_alerts").alias("hotspot_count"),
        rnd(mean_of(F.col("sum_uhi"), F.col("n_uhi")), 4).alias("avg_uhi"))


def extreme_heat(obs: DataFrame, limit_c: float = EXTREME_HEAT_C) -> DataFrame:
    """All columns of observations with an urban day temperature above the limit."""
    return obs.filter(F.col(URBAN) > F.lit(float(limit_c)))


def event_floors(source: DataFrame, k: int = 10) -> DataFrame:
    """Per city the k-th highest monthly maximum, from observations or cells.

    k months reach it, so at least k observations do: lower ones are not among the k highest.
    A city with fewer than k months has no row here.
    """
    order = Window.partitionBy("city").orderBy(F.desc("max_uhi"))
    return (as_cells(source).filter(F.col("max_uhi").isNotNull())
            .withColumn("place", F.row_number().over(order)).filter(F.col("place") == k)
            .select(F.col("city").alias("floor_city"), F.col("max_uhi").alias("floor")))


def top_events(obs: DataFrame, k: int = 10, floors: DataFrame | None = None) -> DataFrame:
    """The k highest observations per city; ties go to the earlier date, then the lower measures.

    ``event_floors`` of the same k (or a higher one) drop nearly all rows before the sort; they are
    settled here unless given.
    """
    floors = settle(event_floors(obs, k), "floors") if floors is None else floors
    obs = (obs.join(floors, F.col("city").eqNullSafe(F.col("floor_city")), "left")
           .filter(F.col("floor").isNull() | (F.col(UHI) >= F.col("floor"))).select(*obs.columns))
    ties = [F.asc_nulls_first(c) for c in ("date", URBAN, "LST_Day_Rural", "LST_Night_Urban")]
    order = Window.partitionBy("city").orderBy(F.desc_nulls_last(UHI), *ties)
    return obs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
