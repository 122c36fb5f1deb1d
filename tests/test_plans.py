"""Whole jobs, and the shape of the plans that matter at scale."""

import math
import re

import pytest
from pyspark.sql import functions as F

from thermalis import fixtures as fx
from thermalis.__main__ import main
from thermalis.operators import hotspots as hot
from thermalis.operators import pixels as pix
from thermalis.operators.ordering import placed
from thermalis.plans import build_observations
from thermalis.schema import RESULTS
from thermalis.sources import durable
from thermalis.sources import Publication, load_results, publish_tables, published, read_obs, remove_old_versions, scratch_run, settle, write_obs
from thermalis.sources.durable import scratch_root

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_settled_thresholds_are_broadcast_and_large_ones_are_not(spark, tmp_path):
    write_obs(fx.obs(spark, SF), str(tmp_path / "obs"))
    obs = read_obs(spark, str(tmp_path / "obs"))
    limits = settle(hot.thresholds(obs), "limits")
    assert "BroadcastHashJoin" in plan(hot.hotspots(obs, limits))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(hot.hotspots(obs, limits))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_events_are_limited_before_the_shuffle(spark):
    text = plan(hot.top_events(fx.obs(spark, SF)))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_extreme_heat_reaches_the_scan(spark, tmp_path):
    write_obs(fx.obs(spark, SF), str(tmp_path / "obs"))
    df = hot.extreme_heat(read_obs(spark, str(tmp_path / "obs"))).filter("city = 'NATION_1'")
    assert "GreaterThan(LST_Day_Urban,45.0)" in df._jdf.queryExecution().toString()
    assert "NATION_1" in plan(df).split("PartitionFilters")[1].split("]")[0]


def test_threshold_values_are_pruned_before_the_shuffle(spark):
    obs = fx.obs(spark, SF)
    text = plan(hot.thresholds(obs, targets=settle(hot.threshold_targets(obs), "targets")))
    above = text[:text.index("lineitem.parquet")]
    scan = above[above.rindex("Exchange hashpartitioning"):]
    assert "partial_count" in scan and "BroadcastHashJoin [key" in scan and text.count("lineitem.parquet") == 1


def test_a_hot_bin_is_split_where_targets_are_not_broadcast(spark):
    obs = fx.obs(spark, SF)
    targets = settle(hot.threshold_targets(obs), "targets")
    want = sorted(map(tuple, hot.thresholds(obs, targets=targets).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = hot.thresholds(obs, targets=targets)
        text = plan(df)
        counts = text[:text.index("SortMergeJoin [key#") if "SortMergeJoin [key#" in text else None]
        assert "SortMergeJoin" in text and re.search(r"Exchange hashpartitioning\(key#\d+, measure#\d+, bin#\d+L?, value#\d+", text), counts
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_third_of_all_rows_in_one_city_does_not_skew_the_sketches(spark):
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 50) END AS city", "CAST(2003 + id % 1 AS INT) AS year",
        "CAST(1 + id % 1 AS INT) AS month",
        "CAST(hash(id) % 1000 AS DOUBLE) AS UHI_Index", "CAST(hash(id, 1) % 1000 AS DOUBLE) AS LST_Day_Urban").repartition(12)
    sketches = hot.measure_sketches(rows, k=512)
    text = plan(sketches)
    assert re.search(r"Exchange hashpartitioning\(city#\d+, year#\d+, month#\d+, \w+#", text)
    limits = hot.sketched_thresholds(settle(sketches, "sketches"), k=512, rounded=False)
    worst = hot.threshold_ranks(rows, limits).agg({"error": "max"}).first()[0]
    assert worst <= 0.03 and limits.count() == 51


def test_places_are_gapless_and_no_task_numbers_all_rows(spark):
    rows = [(i % 7 if i % 11 else None, f"n{i % 13}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b string, id int").repartition(5)
    found = placed(df, F.desc_nulls_last("a"), "b", "id")
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(found.collect(), key=lambda r: r.place)] == want
    assert sorted(r.place for r in found.collect()) == list(range(1, 2001))
    assert "SinglePartition" not in plan(found).split("BroadcastExchange")[0]
    assert placed(df.limit(0), "a").collect() == []


def tables_in(folder):
    return [p for p in folder.rglob("*") if p.name.startswith("part-")]


def test_a_failed_publication_leaves_the_old_tables(spark, tmp_path):
    base = str(tmp_path / "out")
    yearly = spark.createDataFrame([("a", 2003, 1.0)], "city string, year int, avg_uhi double")
    publish_tables({"one": yearly, "two": yearly}, base)
    failed = Publication(spark, base)
    failed.write("one", yearly.withColumn("year", F.lit(2004)))
    with pytest.raises(Exception):
        failed.write("two", yearly.withColumn("year", F.raise_error(F.lit("stopped"))))
    before = published(spark, base)
    assert [r.year for r in spark.read.option("header", True).csv(before["one"]).collect()] == ["2003"]
    publish_tables({"one": yearly.withColumn("year", F.lit(2005))}, base)
    now = published(spark, base)
    assert set(now) == {"one", "two"} and now["two"] == before["two"] and now["one"] != before["one"]
    remove_old_versions(spark, base)
    assert published(spark, base) == now and not (tmp_path / before["one"].removeprefix(str(tmp_path) + "/")).exists()


def test_a_run_leaves_no_scratch_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(durable, "scratch_root", lambda spark: str(tmp_path))
    with pytest.raises(RuntimeError), scratch_run(spark):
        settle(spark.range(5), "numbers")
        assert tables_in(tmp_path)
        raise RuntimeError
    assert not tables_in(tmp_path)
    settle(spark.range(5), "numbers")
    assert tables_in(tmp_path)


def test_zones_join_is_a_hash_join(spark):
    cells = settle(pix.region_cells(fx.regions(spark, SF)), "cells")
    assert "BroadcastHashJoin" in plan(pix.zones(fx.pixels(spark, SF), cells))


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_all_jobs(spark, tmp_path):
    rows = [(c, f"{y}-{m:02d}-15", 35.0 + m + k, 34.0 + m, 15.0 + m, k + math.sin(m))
            for k, c in enumerate(("Pune", "Surat", "Kochi")) for y in range(2010, 2025) for m in range(1, 13)]
    raw = spark.createDataFrame(rows, "city string, date string, LST_Day_Urban double, LST_Day_Rural double, "
                                      "LST_Night_Urban double, UHI_Index double")
    raw.write.option("header", True).csv(str(tmp_path / "raw"))
    common = ["--raw", str(tmp_path / "raw"), "--obs", str(tmp_path / "obs"), "--model", str(tmp_path / "model")]
    for job in ("ingest", "core", "hotspots", "temporal", "forecast"):
        main([job, *common, "--out", str(tmp_path / "steps")])
    main(["publish", *common, "--out", str(tmp_path / "whole"), "--format", "parquet"])
    reports = {"metrics", "prediction_errors", "forecast_summary", "feature_importance", "hotspot_summary"}
    for out in ("steps", "whole"):
        assert set(published(spark, str(tmp_path / out))) == set(RESULTS) | reports
    steps, whole = load_results(spark, str(tmp_path / "steps")), load_results(spark, str(tmp_path / "whole"), "parquet")
    for key in steps:
        a, b = steps[key], whole[key]
        assert a.columns == b.columns and a.count() == b.count() > 0, key
        assert a.exceptAll(b).isEmpty(), key
    assert steps["all_clean"].count() == len(rows) and steps["forecast"].count() == 3 * 72


def test_pixel_job(spark, tmp_path):
    px = spark.sql("""SELECT TIMESTAMP_NTZ '2003-03-01' AS t, lon, 18.5D AS lat, 0 AS QC_Day, dn AS LST_Day_1km, 14000 AS LST_Night_1km
                      FROM VALUES (73.8D, 15000), (73.7D, 14900) v(lon, dn)""")
    px.write.parquet(str(tmp_path / "px"))
    main(["pixels", "--raw", str(tmp_path / "px"), "--out", str(tmp_path / "raw"), "--first-year", "2003", "--last-year", "2003"])
    obs = build_observations(spark, str(tmp_path / "raw"), sentinel=-9999.0).collect()
    assert [(r.city, str(r.date), round(r.LST_Day_Urban, 2), round(r.UHI_Index, 2)) for r in obs] == [
        ("Pune", "2003-03-01", 26.85, 2.0)]


def test_period_mean_and_per_image_jobs(spark, tmp_path):
    px = spark.sql("""SELECT TIMESTAMP_NTZ '2003-03-01' AS t, lon, 18.5D AS lat, 0 AS QC_Day, dn AS LST_Day_1km, 14000 AS LST_Night_1km
                      FROM VALUES (73.8D, 15000), (73.7D, 14900) v(lon, dn)""")
    px.write.parquet(str(tmp_path / "px"))
    (tmp_path / "regions.csv").write_text("city,x0,y0,x1,y1\nHere,73.75,18.4,73.9,18.6\n")
    common = ["--raw", str(tmp_path / "px"), "--out", str(tmp_path / "out"), "--format", "parquet",
              "--regions", str(tmp_path / "regions.csv"), "--first-year", "2003", "--last-year", "2003"]
    for job in ("period_mean", "per_image"):
        main([job, *common])
    folders = published(spark, str(tmp_path / "out"))
    mean = spark.read.parquet(folders["pixel_period_mean"]).collect()
    assert sorted((r.lon, round(r.mean_day_c, 2)) for r in mean) == [(73.7, 24.85), (73.8, 26.85)]
    images = spark.read.parquet(folders["zonal_per_image"]).collect()
    assert [(r.city, r.date, round(r.LST_Urban, 2), round(r.UHI_Index, 2)) for r in images] == [
        ("Here", "2003-03-01", 26.85, 2.0)]
