import math
import random
import re

import pytest
from pyspark.sql import functions as F

from thermalis.operators import pixels as pix
from thermalis.plans import build_observations, pixels_to_observations
from thermalis.schema import PIXELS, REGIONS
from thermalis.sources import read_pixels, settle, write_by_city, write_pixels

from conftest import rows_of


@pytest.fixture(scope="module")
def regions(spark):
    return spark.createDataFrame([("one", 10.0, 20.0, 10.3, 20.2), ("two", 10.35, 20.1, 10.6, 20.4),
                                  ("south", -0.1, -60.2, 0.2, -60.0)], REGIONS)


def pixels_of(spark, rows):
    return spark.createDataFrame([(t, *rest) for t, *rest in rows], "t string, lon double, lat double, "
                                 "QC_Day int, LST_Day_1km int, LST_Night_1km int").withColumn(
                                     "t", F.col("t").cast("timestamp_ntz")).select(*PIXELS.names)


def metres(lon, lat, box):
    x, y = min(max(lon, box[0]), box[2]), min(max(lat, box[1]), box[3])
    a, b = math.radians(lat), math.radians(y)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(x - lon) / 2) ** 2
    return 2 * pix.EARTH_M * math.asin(math.sqrt(h))


@pytest.mark.parametrize("cell", [0.05, 0.25, 3.0])
def test_zones_against_all_pairs(spark, regions, cell):
    random.seed(3)
    spots = [(10.2 + random.uniform(-1, 1), 20.2 + random.uniform(-1, 1)) for _ in range(1500)]
    spots += [(random.uniform(-1, 1), -60.1 + random.uniform(-0.6, 0.6)) for _ in range(1500)]
    spots += [(10.0, 20.0), (10.3, 20.2), (10.6, 20.1)]
    px = spark.createDataFrame(spots, "lon double, lat double")
    want = set()
    for city, *box in [tuple(r) for r in regions.collect()]:
        for lon, lat in spots:
            away = metres(lon, lat, box)
            if away <= 20000:
                want.add((lon, lat, city, "urban" if away == 0 else "rural"))
    got = [tuple(r) for r in pix.zones(px, regions, cell=cell).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len({c for *_, c, _ in got}) == 3


def test_mask_and_scale(spark):
    px = pixels_of(spark, [("2003-01-01", 0.0, 0.0, q, 15000, 14000) for q in (0, 1, 2, 3, 4)])
    got = [tuple(r) for r in pix.to_celsius(pix.qa_mask(px)).select("LST_Day_C", "LST_Night_C").collect()]
    assert got[0] == got[4] == (pytest.approx(26.85), pytest.approx(6.85))
    assert got[1:4] == [(None, None)] * 3


def test_period_end_is_exclusive_and_reaches_the_scan(spark, tmp_path):
    pixels_of(spark, [(d, 0.0, 0.0, 0, 1, 1) for d in ("2003-01-01", "2003-01-31", "2003-02-01")]).write.parquet(str(tmp_path / "p"))
    got = pix.select_period(spark.read.parquet(str(tmp_path / "p")), "2003-01-01", "2003-02-01", ["LST_Day_1km"])
    assert got.count() == 2 and got.columns == ["t", "lon", "lat", "LST_Day_1km"]
    assert "GreaterThanOrEqual(t,2003-01-01" in got._jdf.queryExecution().toString()


def test_months_without_images_are_filled(spark):
    px = pix.to_celsius(pix.qa_mask(pixels_of(spark, [
        ("2003-01-01", 0.0, 0.0, 0, 15000, 15000), ("2003-01-09", 0.0, 0.0, 0, 15100, 15000),
        ("2003-02-01", 1.0, 1.0, 1, 15000, 15000)])))
    composite = pix.monthly_composite(px, (2003, 2004))
    got = {(r.lon, r.year, r.month): r.LST_Day_C for r in pix.filled_composite(composite, (2003, 2004)).collect()}
    assert got[0.0, 2003, 1] == pytest.approx(27.85) and got[1.0, 2003, 2] is None
    assert (1.0, 2003, 1) not in got and (0.0, 2003, 2) not in got
    assert len(got) == 2 + 2 * 22 and got[0.0, 2003, 3] == got[1.0, 2004, 12] == -9999.0
    assert composite.count() == 2
    gaps = {(r.year, r.month) for r in pix.month_gaps(composite, (2003, 2004)).collect()}
    assert gaps == {(y, m) for y in (2003, 2004) for m in range(1, 13)} - {(2003, 1), (2003, 2)}
    whole = spark.createDataFrame([(0.0, 0.0, 2003, m, 1.0, 1.0) for m in range(1, 13)], composite.schema)
    assert pix.filled_composite(whole, (2003, 2003)).count() == 12


def test_missing_pixels_enter_the_zonal_mean_as_fill(spark, regions):
    inside, ring = (10.1, 20.1), (9.95, 20.1)
    px = pixels_of(spark, [
        ("2003-01-01", *inside, 0, 15000, 14000), ("2003-01-01", 10.15, 20.1, 1, 15000, 14000),
        ("2003-01-01", *ring, 0, 14000, 14000)])
    got = {(r.city, r.month): r for r in pixels_to_observations(px, regions.limit(1), (2003, 2003)).collect()}
    assert len(got) == 12
    assert got["one", 1].LST_Day_Urban == pytest.approx((26.85 - 9999) / 2)
    assert got["one", 1].LST_Day_Rural == pytest.approx(6.85)
    assert got["one", 1].UHI_Index == pytest.approx((26.85 - 9999) / 2 - 6.85)
    assert got["one", 2].LST_Day_Urban == -9999.0 and got["one", 2].UHI_Index == 0.0
    plain = pixels_to_observations(px, regions.limit(1), (2003, 2003), fill=None).collect()
    assert [(r.month, round(r.LST_Day_Urban, 2), round(r.UHI_Index, 2)) for r in plain] == [(1, 26.85, 20.0)]


def test_regions_and_zones_without_pixels_are_filled(spark, regions):
    px = pixels_of(spark, [("2003-01-01", 10.1, 20.1, 0, 15000, 14000)])
    cities = regions.filter("city <> 'two'")
    got = {(r.city, r.month): r for r in pixels_to_observations(px, cities, (2003, 2003)).collect()}
    assert len(got) == 24 and got["one", 1].LST_Day_Urban == pytest.approx(26.85)
    assert got["one", 1].LST_Day_Rural == got["south", 1].LST_Day_Urban == -9999.0
    assert got["one", 1].UHI_Index == pytest.approx(26.85 + 9999) and got["south", 12].UHI_Index == 0.0


def test_exported_series_can_be_ingested(spark, regions, tmp_path):
    px = pixels_of(spark, [("2003-03-01", 10.1, 20.1, 0, 15000, 14000), ("2003-03-01", 9.95, 20.1, 0, 14900, 14000)])
    write_by_city(pixels_to_observations(px, regions, (2003, 2003)), str(tmp_path / "raw"))
    assert sorted(p.name for p in (tmp_path / "raw").glob("city=*")) == ["city=one", "city=south", "city=two"]
    obs = build_observations(spark, str(tmp_path / "raw"), sentinel=-9999.0)
    assert rows_of(obs.withColumn("uhi", F.round("UHI_Index", 6)).withColumn("day", F.col("date").cast("string")),
                   "city", "day", "uhi") == [("one", "2003-03-01", 2.0)]


def test_series_per_image(spark, regions):
    px = pix.to_celsius(pix.qa_mask(pixels_of(spark, [
        ("2003-01-01", 10.1, 20.1, 0, 15000, 0), ("2003-01-01", 10.1, 20.15, 1, 10, 0), ("2003-01-01", 9.95, 20.1, 0, 14900, 0),
        ("2003-01-09", 10.1, 20.1, 0, 15000, 0)])))
    got = pix.zonal_per_image(px, regions, "one").orderBy("date").collect()
    assert [(r.date, round(r.LST_Urban, 2), r.UHI_Index and round(r.UHI_Index, 2)) for r in got] == [
        ("2003-01-01", 26.85, 2.0), ("2003-01-09", 26.85, None)]


def test_collection_stats(spark):
    px = pixels_of(spark, [(d, 0.0, 0.0, 0, 1, 1) for d in ("2003-01-09", "2003-01-01", "2003-01-01")])
    got = pix.collection_stats(px).first()
    assert got.images == 2 and str(got.first_date) == "2003-01-01"


def test_clipping_reaches_the_scan(spark, regions, tmp_path):
    random.seed(5)
    spots = [("2003-01-01", random.uniform(9, 12), random.uniform(19, 22), 0, 1, 1) for _ in range(800)]
    pixels_of(spark, [*spots, ("2003-01-01", 100.0, 20.0, 0, 1, 1), ("2003-01-01", 10.1, 80.0, 0, 1, 1)]).write.parquet(str(tmp_path / "px"))
    px, some = spark.read.parquet(str(tmp_path / "px")), regions.filter("city <> 'south'")
    for cell in (0.05, 0.25):
        near = pix.clipped(px, pix.region_cells(some, cell=cell))
        assert 0 < near.count() < 800
    assert pix.clipped(px, pix.region_cells(some).limit(0)).isEmpty()
    masked = pix.to_celsius(pix.qa_mask(px))
    for df in (pix.zonal_per_image(masked, some), pix.zone_composite(masked, some, (2003, 2003)), pix.zones(px, some)):
        assert re.search(r"Filter .*lon#\d+ >= [\d.]+.*\n[ :]*\+- Relation", df._jdf.queryExecution().optimizedPlan().toString())


def test_tiles_are_pruned_while_the_query_runs(spark, regions, tmp_path):
    random.seed(6)
    spots = [("2003-01-01", random.uniform(-180, 180), random.uniform(-89, 89), 0, 15000, 1) for _ in range(500)]
    spots += [("2003-01-01", 10.3 + random.uniform(-1, 1), 20.2 + random.uniform(-1, 1), 0, 15000, 1) for _ in range(500)]
    px = pixels_of(spark, spots)
    write_pixels(px, str(tmp_path / "px"))
    tiled, covered = read_pixels(spark, str(tmp_path / "px")), settle(pix.region_cells(regions), "cells")
    found = pix.zones(tiled, covered)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert rows_of(found, "lon", "lat", "city", "zone") == rows_of(pix.zones(px, covered), "lon", "lat", "city", "zone")
    read = found._jdf.queryExecution().executedPlan().toString()
    assert tiled.count() == 1000 and "tile_x" in read
    with pytest.raises(ValueError):
        pix.in_tiles(tiled, covered, cell=0.7)


def around(lon, lat, box):
    return min(metres(lon + turn, lat, box) for turn in (-360, 0, 360))


@pytest.mark.parametrize("cell", [0.25, 3.0])
def test_zones_across_the_date_line(spark, cell):
    random.seed(9)
    table = [("edge", 179.9, 10.0, -179.8, 10.3), ("west", -180.0, 20.0, -179.7, 20.2), ("east", 179.75, -60.2, 180.0, -60.0),
             ("north", 179.5, 80.0, 179.9, 80.2)]
    boxes = {c: (x0, y0, x1 + 360 if x1 < x0 else x1, y1) for c, x0, y0, x1, y1 in table}
    spots = [(random.choice([-1, 1]) * (180 - random.uniform(0, 2) ** 2), y + random.uniform(-0.5, 0.6)) for y in (10, 20, -60, 80) for _ in range(900)]
    spots += [(180.0, 10.1), (-180.0, 10.1), (180.0, 20.1), (-180.0, -60.1), (0.0, 10.1)]
    want = {(lon, lat, city, "urban" if around(lon, lat, box) == 0 else "rural") for lon, lat in spots for city, box in boxes.items()
            if around(lon, lat, box) <= 20000}
    px = spark.createDataFrame(spots, "lon double, lat double")
    got = [tuple(r) for r in pix.zones(px, spark.createDataFrame(table, REGIONS), cell=cell).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len({r[2:] for r in got}) == 8


def test_box_of_regions_on_both_sides_of_the_date_line(spark):
    spots = [(lon, 0.0) for lon in (-179.95, -179.0, 0.0, 179.0, 179.95)]
    px = spark.createDataFrame(spots, "lon double, lat double")

    def kept(*table):
        cells = pix.region_cells(spark.createDataFrame(list(table), REGIONS))
        return sorted(r.lon for r in pix.clipped(px, cells).collect())

    assert kept(("a", 179.9, -0.1, -179.9, 0.1)) == [-179.95, 179.95]
    assert kept(("a", -179.99, -0.1, -179.9, 0.1)) == [-179.95, 179.95]
    assert kept(("a", 178.9, -0.1, 179.1, 0.1)) == [179.0]
    assert kept(("a", 178.9, -0.1, 179.1, 0.1), ("b", -179.99, -0.1, -179.9, 0.1)) == [s for s, _ in spots]


def test_edge_pixels_count_by_their_share(spark):
    box, size, k = (10.0, 20.0, 10.3, 20.2), (0.1, 0.05), 4
    regions = spark.createDataFrame([("one", *box)], REGIONS)
    random.seed(4)
    spots = [(10.15 + random.uniform(-0.5, 0.5), 20.1 + random.uniform(-0.4, 0.4)) for _ in range(600)] + [(10.0, 20.1), (10.3, 20.2), (10.1, 20.1)]
    want = {}
    for lon, lat in spots:
        w = max(0, min(lon + 0.05, box[2]) - max(lon - 0.05, box[0])) / 0.1
        h = max(0, min(lat + 0.025, box[3]) - max(lat - 0.025, box[1])) / 0.05
        points = [(lon + size[0] * ((i + 0.5) / k - 0.5), lat + size[1] * ((j + 0.5) / k - 0.5)) for i in range(k) for j in range(k)]
        ring = sum(0 < metres(*p, box) <= 20000 for p in points) / k ** 2
        want |= {(lon, lat, zone): share for zone, share in (("urban", w * h), ("rural", ring)) if share}
    px = spark.createDataFrame(spots, "lon double, lat double")
    got = {(r.lon, r.lat, r.zone): r.weight for r in pix.zones(px, regions, footprint=size).collect()}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)
    assert any(0 < w < 1 for w in want.values()) and got[10.1, 20.1, "urban"] == pytest.approx(1)
    masked = spark.createDataFrame([("2003-01-01", lon, lat, lon + lat, 1.0) for lon, lat in spots],
                                   "t string, lon double, lat double, LST_Day_C double, LST_Night_C double")
    row, = pix.zonal_series(pix.zone_composite(masked, regions, (2003, 2003), footprint=size), (2003, 2003)).collect()
    for name, zone in (("LST_Day_Urban", "urban"), ("LST_Day_Rural", "rural")):
        own = [(x[0] + x[1], w) for x, w in want.items() if x[2] == zone]
        assert row[name] == pytest.approx(sum(v * w for v, w in own) / sum(w for _, w in own))


def test_the_composite_reads_the_pixels_once(spark, tmp_path):
    pixels_of(spark, [("2003-01-01", 0.0, 0.0, 0, 1, 1)]).write.parquet(str(tmp_path / "p"))
    px = pix.to_celsius(pix.qa_mask(spark.read.parquet(str(tmp_path / "p"))))
    text = pix.monthly_composite(px, (2003, 2003))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1


def test_shares_are_found_once_per_place(spark, monkeypatch):
    """Not once per image; a region that is listed twice changes nothing."""
    regions = spark.createDataFrame([("one", 10.0, 20.0, 10.3, 20.2)], REGIONS)
    images = [(f"2003-{m:02}-{d:02}", lon, 20.1, 1.0 * m * d, 2.0) for m in (1, 2) for d in range(1, 9) for lon in (9.9, 10.0, 10.1, 40.0)]
    px = spark.createDataFrame(images, "t string, lon double, lat double, LST_Day_C double, LST_Night_C double")
    asked, plain = [], pix.zones
    monkeypatch.setattr(pix, "zones", lambda rows, *a, **b: asked.append(rows.count()) or plain(rows, *a, **b))
    once = sorted(tuple(r) for r in pix.zone_composite(px, regions, (2003, 2003), footprint=(0.1, 0.05)).collect())
    assert asked == [3] and len(once) == 8
    assert sorted(tuple(r) for r in pix.zone_composite(px, regions.union(regions), (2003, 2003), footprint=(0.1, 0.05)).collect()) == once
