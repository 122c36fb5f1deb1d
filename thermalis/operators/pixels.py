"""Pixel tables to zonal temperature series.

A pixel row is one image and pixel (t, lon, lat, raw bands). Pixels belong to a zone by their centre, or, if their
footprint is given, by the share of it that lies in the zone. Longitudes meet at the date line; a rectangle may cross it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermalis.functions.fixed import DN_SCALE, KELVIN_OFFSET, MISSING_C, QC_BITS, RING_M
from thermalis.functions.numbers import mean_of

RAW_BANDS = {"LST_Day_1km": "LST_Day_C", "LST_Night_1km": "LST_Night_C"}
DAY, NIGHT = RAW_BANDS.values()
EARTH_M = 6371008.8
CELL_DEG = 0.25
#: Side of a tile of the pixel table; a multiple of the cell.
TILE_DEG = 5.0
#: Points along each side of a footprint at which the ring is looked up.
FOOTPRINT_STEPS = 4


def select_period(px: DataFrame, start: str, end: str, bands=None) -> DataFrame:
    """Images from start up to but not including end; optionally only some bands."""
    rows = px.filter((F.col("t") >= F.lit(start)) & (F.col("t") < F.lit(end)))
    return rows if bands is None else rows.select("t", "lon", "lat", *bands)


def qa_mask(px: DataFrame, qa: str = "QC_Day", bits: int = QC_BITS) -> DataFrame:
    """Null every band whose quality flag has one of the bits set. The day flag serves both bands."""
    good = F.col(qa).bitwiseAND(F.lit(bits)) == 0
    return px.withColumns({b: F.when(good, F.col(b)) for b in RAW_BANDS if b in px.columns})


def to_celsius(px: DataFrame) -> DataFrame:
    """Raw numbers to °C under the Celsius band names; other columns stay."""
    return px.select(*[
        (F.col(c) * F.lit(DN_SCALE) - F.lit(KELVIN_OFFSET)).alias(RAW_BANDS[c]) if c in RAW_BANDS else F.col(c)
        for c in px.columns if c != "QC_Day"
    ])


def collection_stats(px: DataFrame) -> DataFrame:
    """Number of images and date of the first."""
    return px.agg(F.count_distinct("t").alias("images"), F.min("t").cast("date").alias("first_date"))


def period_mean(px: DataFrame) -> DataFrame:
    """Mean day temperature per pixel over all its images."""
    return px.groupBy("lon", "lat").agg(F.avg(DAY).alias("mean_day_c"))


def _in_years(px: DataFrame, years) -> DataFrame:
    return select_period(px, f"{years[0]}-01-01", f"{years[1] + 1}-01-01")


def _with_months(px: DataFrame) -> DataFrame:
    return px.withColumns({"year": F.year("t"), "month": F.month("t")})


def _means(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(F.avg(DAY).alias(DAY), F.avg(NIGHT).alias(NIGHT))


def monthly_composite(px: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Mean per pixel and month, for the pixel-months that exist; one reading of the pixels."""
    return _means(_with_months(_in_years(px, years)), "lon", "lat", "year", "month")


def month_gaps(composite: DataFrame, years: tuple[int, int]) -> DataFrame:
    """year, month: the months of the years that no pixel has, from one set of bits per year."""
    bit = F.expr("shiftleft(1, month - 1)")
    seen = composite.groupBy("year").agg(F.bit_or(bit).alias("months"))
    calendar = composite.sparkSession.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias("year"))
    gaps = F.filter(F.sequence(F.lit(1), F.lit(12)), lambda m: F.getbit(F.coalesce("months", F.lit(0)), m - 1) == 0)
    return calendar.join(seen, "year", "left").select("year", F.explode(gaps).alias("month"))


def filled_composite(composite: DataFrame, years: tuple[int, int], fill: float = MISSING_C) -> DataFrame:
    """The composite, and the constant ``fill`` for every pixel in months that no pixel has.

    Reads the composite three times, so settle it first; the pixels themselves are not read again.
    """
    # At most twelve months a year, and none at all where every month has an image.
    gaps = month_gaps(composite, years).agg(F.collect_list(F.struct("year", "month")))
    filled = (composite.select("lon", "lat").distinct().select("lon", "lat", F.inline(gaps.scalar()))
              .withColumns({DAY: F.lit(fill), NIGHT: F.lit(fill)}))
    return composite.unionByName(filled)


def _distance_m(lon: Column, lat: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance (haversine)."""
    p, q = F.radians(lat), F.radians(lat2)
    half = (F.pow(F.sin((q - p) / 2), F.lit(2.0))
            + F.cos(p) * F.cos(q) * F.pow(F.sin((F.radians(lon2) - F.radians(lon)) / 2), F.lit(2.0)))
    return F.asin(F.sqrt(half)) * F.lit(2 * EARTH_M)


def _around(lon: Column, x0: Column, x1: Column) -> Column:
    """The longitude, turned to the side of the date line that a rectangle is on."""
    return lon + 360 * F.round(((x0 + x1) / 2 - lon) / 360)


def _circle(cell: float) -> int:
    """Cells around the globe."""
    n = round(360 / cell)
    if abs(n * cell - 360) > 1e-9:
        raise ValueError(f"{cell} degrees do not divide the circle")
    return n


def _on_circle(index: Column, n: int) -> Column:
    """The cell number west to east from -n/2, whatever side of the date line it was counted on."""
    return F.pmod(index + n // 2, F.lit(n)) - n // 2


def region_cells(regions: DataFrame, buffer_m: float = RING_M, cell: float = CELL_DEG,
                 footprint: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Each region once per grid cell that its buffered rectangle touches, with the box (west to north) around that.

    With a footprint (degrees of longitude and latitude), the box also holds pixels that reach in from outside. A
    rectangle whose x1 is less than its x0 crosses the date line.
    """
    n = _circle(cell)
    pad = F.lit(buffer_m / EARTH_M * 57.29577951308232 * 1.001)
    far = F.greatest(F.abs("y0"), F.abs("y1")) + pad
    pad_lon = pad / F.greatest(F.cos(F.radians(far)), F.lit(0.01))
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    boxes = (regions.select("city", x0.alias("x0"), y0.alias("y0"), F.when(x1 < x0, x1 + 360).otherwise(x1).alias("x1"), y1.alias("y1"))
             .withColumns({"west": F.col("x0") - pad_lon - footprint[0] / 2, "east": F.col("x1") + pad_lon + footprint[0] / 2,
                           "south": F.col("y0") - pad - footprint[1] / 2, "north": F.col("y1") + pad + footprint[1] / 2}))
    first = F.floor(F.col("west") / cell)
    columns = F.sequence(first, F.least(F.floor(F.col("east") / cell), first + n - 1))
    return (boxes.withColumn("cx", F.explode(columns)).withColumn("cx", _on_circle(F.col("cx"), n))
            .withColumn("cy", F.explode(F.sequence(F.floor(F.col("south") / cell), F.floor(F.col("north") / cell)))))


def clipped(px: DataFrame, covered: DataFrame) -> DataFrame:
    """Pixels in the box around all region cells.

    The box comes to the driver as one row, so that the filter is of literals and skips files and row groups of
    a table that is sorted or split by place.
    """
    west, east, south, north = covered.agg(F.min("west"), F.max("east"), F.min("south"), F.max("north")).first()
    if west is None:  # no region
        return px.filter(F.lit(False))
    lon, inside = F.col("lon"), F.col("lat").between(south, north)
    if east - west < 360:
        turned = [lon.between(west, east)]
        if east > 180:
            turned.append(lon <= east - 360)
        if west < -180:
            turned.append(lon >= west + 360)
        inside = inside & (turned[0] if len(turned) == 1 else turned[0] | turned[1] if len(turned) == 2 else F.lit(True))
    return px.filter(inside)


def tile_columns(tile: float = TILE_DEG) -> dict[str, Column]:
    """The tile of a pixel: the columns by which the pixel table is partitioned."""
    return {"tile_x": _on_circle(F.floor(F.col("lon") / tile), _circle(tile)).cast("int"),
            "tile_y": F.floor(F.col("lat") / tile).cast("int")}


def in_tiles(px: DataFrame, covered: DataFrame, cell: float = CELL_DEG, tile: float = TILE_DEG) -> DataFrame:
    """Pixels of a tiled table in tiles that a region touches; the regions prune its partitions while the query runs."""
    per_tile = round(tile / cell)
    if abs(per_tile * cell - tile) > 1e-9:
        raise ValueError("a tile must be a multiple of the cell")
    tiles = covered.filter("south <= north").select(
        F.floor(F.col("cx") / per_tile).cast("int").alias("tile_x"), F.floor(F.col("cy") / per_tile).cast("int").alias("tile_y")).distinct()
    return px.join(tiles, ["tile_x", "tile_y"], "left_semi")


def _in_cells(px: DataFrame, covered: DataFrame, cell: float = CELL_DEG) -> DataFrame:
    """Pixels in the box around all regions and, of a tiled table, in their tiles; cx and cy are their grid cells."""
    rows = clipped(px, covered)
    if "tile_x" in px.columns:
        rows = in_tiles(rows, covered, cell)
    return rows.withColumns({"cx": _on_circle(F.floor(F.col("lon") / cell), _circle(cell)), "cy": F.floor(F.col("lat") / cell)})


def _ring_share(lon: Column, footprint: tuple[float, float], buffer_m: float, steps: int) -> Column:
    """The share of a footprint in the ring, by a grid of points."""
    found = F.lit(0)
    for i in range(steps):
        for j in range(steps):
            x = lon + footprint[0] * ((i + 0.5) / steps - 0.5)
            y = F.col("lat") + footprint[1] * ((j + 0.5) / steps - 0.5)
            near_x, near_y = F.greatest(F.least(x, F.col("x1")), F.col("x0")), F.greatest(F.least(y, F.col("y1")), F.col("y0"))
            outside = (near_x != x) | (near_y != y)
            found = found + (outside & (_distance_m(x, y, near_x, near_y) <= buffer_m)).cast("int")
    return found / (steps * steps)


def _overlap(centre: Column, size: float, low: str, high: str) -> Column:
    return F.greatest(F.least(centre + size / 2, F.col(high)) - F.greatest(centre - size / 2, F.col(low)), F.lit(0.0)) / size


def zones(px: DataFrame, regions: DataFrame, buffer_m: float = RING_M, cell: float = CELL_DEG,
          footprint: tuple[float, float] | None = None, steps: int = FOOTPRINT_STEPS) -> DataFrame:
    """Rows of px once per city they belong to, with zone 'urban' (in the rectangle) or 'rural' (in the ring).

    The spatial test runs as a hash join on grid cells: a pixel has one cell, a region some. Pixels far from all
    regions are left out by literals at the scan, and by partition if the pixel table has tiles.
    ``regions`` may also be the settled ``region_cells`` of the same buffer, cell and footprint: Catalyst then
    knows their size and broadcasts them if small enough; otherwise AQE splits hot cells.

    With a footprint (degrees of longitude and latitude) a pixel belongs to each zone that it reaches into, with the
    share as its weight: the exact area in the rectangle, and steps x steps points in the ring.
    """
    covered = regions if "cx" in regions.columns else region_cells(regions, buffer_m, cell, footprint or (0.0, 0.0))
    lat, turned = F.col("lat"), F.col("turned")
    met = _in_cells(px, covered, cell).join(covered, ["cx", "cy"]).withColumn("turned", _around(F.col("lon"), F.col("x0"), F.col("x1")))
    if footprint is None:
        near = _distance_m(turned, lat, F.greatest(F.least(turned, F.col("x1")), F.col("x0")),
                           F.greatest(F.least(lat, F.col("y1")), F.col("y0")))
        inside = turned.between(F.col("x0"), F.col("x1")) & lat.between(F.col("y0"), F.col("y1"))
        return (met.withColumn("zone", F.when(inside, F.lit("urban")).when(near <= buffer_m, F.lit("rural")))
                .filter(F.col("zone").isNotNull()).select(*px.columns, "city", "zone"))
    urban = _overlap(turned, footprint[0], "x0", "x1") * _overlap(lat, footprint[1], "y0", "y1")
    shares = F.array(F.struct(F.lit("urban").alias("zone"), urban.alias("weight")),
                     F.struct(F.lit("rural").alias("zone"), _ring_share(turned, footprint, buffer_m, steps).alias("weight")))
    return met.select(*px.columns, "city", F.inline(shares)).filter("weight > 0")


def zonal_mean(px: DataFrame, regions: DataFrame, zone: str, buffer_m: float = RING_M) -> DataFrame:
    """Mean of both bands over one zone per city, year and month of a monthly composite."""
    return _means(zones(px, regions, buffer_m).filter(F.col("zone") == zone), "city", "year", "month")


def _side(zone: str, band: str) -> Column:
    return F.when(F.col("zone") == zone, F.col(band))


SIDES = {
    "LST_Day_Urban": ("urban", DAY),
    "LST_Day_Rural": ("rural", DAY),
    "LST_Night_Urban": ("urban", NIGHT),
}


def _with_index(series: DataFrame, urban: str, rural: str) -> DataFrame:
    return series.withColumn("UHI_Index", F.col(urban) - F.col(rural))


def zone_composite(px: DataFrame, regions: DataFrame, years: tuple[int, int],
                   buffer_m: float = RING_M, footprint: tuple[float, float] | None = None) -> DataFrame:
    """Monthly means of masked °C pixels, for the pixels of each city's zones only.

    Pixels outside all zones are dropped by the join, before anything is shuffled. A pixel-month
    without a valid value stays as a row of nulls. With a footprint each row has its weight: shares are found once per
    place instead of once per image, and pixels in no cell of a region are dropped before any shuffle.
    """
    rows = _in_years(px, years)
    if footprint is None:
        return _means(_with_months(zones(rows, regions, buffer_m)), "city", "zone", "lon", "lat", "year", "month")
    covered = regions if "cx" in regions.columns else region_cells(regions, buffer_m, footprint=footprint)
    near = _in_cells(rows, covered).join(covered.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")
    shares = zones(near.select("lon", "lat").distinct(), covered, buffer_m, footprint=footprint).distinct()
    return (_means(_with_months(near), "lon", "lat", "year", "month").join(shares, ["lon", "lat"])
            .select("city", "zone", "lon", "lat", "weight", "year", "month", DAY, NIGHT))


def zonal_series(composite: DataFrame, years: tuple[int, int], fill: float | None = None,
                 cities: DataFrame | None = None) -> DataFrame:
    """Monthly urban and rural means and their difference per city, from ``zone_composite``; weighted if that is.

    With ``fill`` every pixel that lacks a value in a month counts as that value, for every month of the
    years: (sum of values + fill * missing pixels) / pixels, without making the missing rows.
    A zone without any pixel is ``fill``, and ``cities`` without pixels have their rows too.
    That form reads the composite twice; settle it first.
    """
    weighted = "weight" in composite.columns

    def size(valid):
        return F.sum(F.when(valid, F.col("weight")).otherwise(0.0)) if weighted else F.count_if(valid)

    def total(value):
        return F.sum(F.col("weight") * value if weighted else value)

    sums = composite.groupBy("city", "year", "month").agg(
        *[total(_side(*side)).alias(f"sum_{name}") for name, side in SIDES.items()],
        *[size(_side(*side).isNotNull()).alias(f"n_{name}") for name, side in SIDES.items()])
    if fill is None:
        means = [mean_of(F.col(f"sum_{name}"), F.col(f"n_{name}")).alias(name) for name in SIDES]
        return _with_index(sums.select("city", "year", "month", *means), "LST_Day_Urban", "LST_Day_Rural")
    sizes = (composite.select("city", "zone", "lon", "lat", *(["weight"] if weighted else [])).distinct()
             .groupBy("city").agg(size(F.col("zone") == "urban").alias("px_urban"), size(F.col("zone") == "rural").alias("px_rural")))
    if cities is not None:
        sizes = cities.select("city").distinct().join(sizes, "city", "left").fillna(0, ["px_urban", "px_rural"])
    grid = (sizes.withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))))
            .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))))

    def filled(name, zone):
        pixels, n = F.col(f"px_{zone}"), F.coalesce(f"n_{name}", F.lit(0))
        total = F.coalesce(f"sum_{name}", F.lit(0.0)) + F.lit(fill) * (pixels - n)
        return F.coalesce(mean_of(total, pixels), F.lit(fill)).alias(name)

    means = [filled(name, zone) for name, (zone, _) in SIDES.items()]
    return _with_index(grid.join(sums, ["city", "year", "month"], "left")
                       .select("city", "year", "month", *means), "LST_Day_Urban", "LST_Day_Rural")


def zonal_per_image(px: DataFrame, regions: DataFrame, city: str | None = None,
                    buffer_m: float = RING_M) -> DataFrame:
    """Urban and rural mean day temperature per image, for one city or all."""
    regions = regions if city is None else regions.filter(F.col("city") == city)
    series = zones(px, regions, buffer_m).groupBy("city", "t").agg(
        F.avg(_side("urban", DAY)).alias("LST_Urban"), F.avg(_side("rural", DAY)).alias("LST_Rural"))
    return _with_index(series.select("city", F.date_format("t", "yyyy-MM-dd").alias("date"),
                                     "LST_Urban", "LST_Rural"), "LST_Urban", "LST_Rural")
