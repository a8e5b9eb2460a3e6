"""Pixel-table operators: band maths, resampling, mosaics, masks, reprojection, summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraquilt.functions import crs, geometry as geo
from terraquilt.functions.geometry import number
from terraquilt.functions.indices import BAND_MAPS, INDEX_NAMES, spectral_indices
from terraquilt.functions.maths import null_if_nan, safe_ratio
from terraquilt.grid import GridSpec
from terraquilt.operators.cover import cover_cells, envelope_join
from terraquilt.operators.quantiles import exact_percentiles
from terraquilt.session import broadcast_if_small, cut_lineage
from terraquilt.sources.readers import tiles_in_window, tiles_to_pixels

PIXEL_COLUMNS = ("raster_id", "band", "row", "col", "value")


def bands_to_columns(pixels: DataFrame, names: dict[int, str]) -> DataFrame:
    """Long to wide: one row per cell, one column per named band, in one aggregation."""
    # FILTER touches the one buffer of a row's band; a CASE in each aggregate would update all of them
    columns = [F.expr(f"max(value) FILTER (WHERE band = {b})").alias(n) for b, n in names.items()]
    return pixels.where(F.col("band").isin(*names)).groupBy("raster_id", "row", "col").agg(*columns)


def align_bands(left: DataFrame, right: DataFrame, keys=("row", "col")) -> DataFrame:
    """Cell-by-cell combination of two wide rasters on the same grid."""
    return left.join(right, list(keys))


def index_bands(wide: DataFrame) -> DataFrame:
    """The 16 spectral indices next to the cell keys."""
    names = ("red", "blue", "green", "nir", "swir16", "swir22")
    values = spectral_indices({n: F.col(n) for n in names})
    keys = [c for c in ("raster_id", "row", "col") if c in wide.columns]
    return wide.select(*keys, *[values[n].alias(n) for n in INDEX_NAMES])


# Fixed value: square feet per square metre of the area ratio.
SQFT_PER_SQM = 10.764


def height_width_ratio(
    buildings: DataFrame, streets: DataFrame, resolution: float, missing: float | None = -1.0
) -> DataFrame:
    """Height over street width, and built area per nominal pixel area.

    A cell without a street width gets ``missing`` (pass None to leave it NULL). The
    divisor is the nominal pixel; a degree-grid cell is really somewhat smaller.
    """
    both = align_bands(
        buildings.select("row", "col", "building_height", "building_area"),
        streets.select("row", "col", "street_width"),
    )
    ratio = safe_ratio(F.col("building_height"), F.col("street_width"))
    if missing is not None:
        ratio = F.coalesce(null_if_nan(ratio), F.lit(float(missing)))
    per_pixel = F.col("building_area") / F.lit(resolution**2 * SQFT_PER_SQM)
    return both.select("row", "col", ratio.alias("var"), per_pixel.alias("building_area_per_pixel"))


def sensor_indices(pixels: DataFrame, sensor: str) -> DataFrame:
    """All 16 indices of a sensor's multi-band pixel table, as a pixel table with one band per index.

    The six inputs are found by the sensor's band numbers; other bands are left out.
    """
    if sensor not in BAND_MAPS:
        raise ValueError(f"unknown sensor {sensor!r}; known: {sorted(BAND_MAPS)}")
    names = {number: name for name, number in BAND_MAPS[sensor].items()}
    wide = bands_to_columns(pixels.where(F.col("band").isin(*names)), names)
    # a projection computes shared parts once, a generator's argument at each place they are used
    indices = index_bands(wide)
    entries = F.array(*[F.struct(F.lit(i).alias("band"), F.col(name).alias("value")) for i, name in enumerate(INDEX_NAMES, start=1)])
    return indices.select("raster_id", "row", "col", F.inline(entries)).select(*PIXEL_COLUMNS)


# ---------------------------------------------------------------- extent and metadata

def raster_extents(pixels: DataFrame) -> DataFrame:
    """Height and width seen in the data, per raster."""
    return pixels.groupBy("raster_id").agg(
        (F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width")
    )


def raster_metadata(meta: DataFrame, band_meta: DataFrame) -> DataFrame:
    """Size, resolution, bounds and band names of each raster; flags a missing SRID."""
    names = band_meta.groupBy("raster_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("band", "name"))), lambda b: b["name"]).alias("bands")
    )
    return meta.join(names, "raster_id", "left").select(
        "raster_id", "srid", "width", "height",
        F.col("px").alias("res_x"), F.col("py").alias("res_y"),
        F.col("x0").alias("xmin"),
        (F.col("y1") - F.col("height") * F.col("py")).alias("ymin"),
        (F.col("x0") + F.col("width") * F.col("px")).alias("xmax"),
        F.col("y1").alias("ymax"),
        "bands",
        (F.coalesce(F.col("srid"), F.lit(0)) == 0).alias("srid_missing"),
    )


# Layer kinds a described copy may carry.
DESCRIBED_KINDS = ("aod", "co", "hcho", "no2", "o3", "so2", "landsat", "sentinel")


def copy_described(pixels: DataFrame, band_meta: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """The same pixels with the first band named after the layer kind."""
    if kind not in DESCRIBED_KINDS:
        raise ValueError(f"unknown layer kind {kind!r}; known: {DESCRIBED_KINDS}")
    named = band_meta.withColumn("name", F.when(F.col("band") == 1, F.lit(kind)).otherwise(F.col("name")))
    return pixels, named


# ---------------------------------------------------------------- selection and masking

def raster_subset(pixels: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Half-open slice of rows and columns, re-indexed to start at 0."""
    cut = pixels.where(
        (F.col("row") >= rows[0]) & (F.col("row") < rows[1]) & (F.col("col") >= cols[0]) & (F.col("col") < cols[1])
    )
    return cut.withColumns({
        "row": (F.col("row") - rows[0]).cast("int"), "col": (F.col("col") - cols[0]).cast("int")
    })


def threshold_to_null(pixels: DataFrame, limit: float = 200.0) -> DataFrame:
    return pixels.withColumn("value", F.when(F.col("value") <= limit, F.col("value")))


def apply_mask(pixels: DataFrame, mask: DataFrame, nodata: float = 255.0, masked: int = 255) -> DataFrame:
    """Set pixels to nodata where the mask band says so; unmasked and unlisted cells keep their value."""
    flags = mask.select("raster_id", "row", "col", F.col("value").alias("_mask"))
    return (
        pixels.join(flags, ["raster_id", "row", "col"], "left")
        .withColumn("value", F.when(F.col("_mask") == masked, F.lit(float(nodata))).otherwise(F.col("value")))
        .select(*pixels.columns)
    )


def clip_tiles(tiles: DataFrame, tile_size: int, grid: GridSpec, bbox) -> tuple[DataFrame, GridSpec]:
    """``clip_bbox`` of a tile table: only tiles that reach into the window are read and opened."""
    rows, cols, _ = clip_window(grid, outline_envelope(bbox, 4326, grid.srid))
    return clip_bbox(tiles_to_pixels(tiles_in_window(tiles, tile_size, rows, cols), tile_size), grid, bbox)


def clip_window(grid: GridSpec, bbox, margin: int = 0) -> tuple[tuple[int, int], tuple[int, int], GridSpec]:
    """Rows and columns whose pixel centres lie in a box given in the grid's own system, and ``margin`` more around them."""
    x0, y0, x1, y1 = bbox
    c0 = max(math.ceil((x0 - grid.x0) / grid.px - 0.5) - margin, 0)
    c1 = min(math.floor((x1 - grid.x0) / grid.px - 0.5) + 1 + margin, grid.width)
    r0 = max(math.ceil((grid.y1 - y1) / grid.py - 0.5) - margin, 0)
    r1 = min(math.floor((grid.y1 - y0) / grid.py - 0.5) + 1 + margin, grid.height)
    cropped = GridSpec(
        grid.x0 + c0 * grid.px, grid.y1 - r0 * grid.py, grid.px, grid.py,
        max(c1 - c0, 0), max(r1 - r0, 0), grid.srid,
    )
    return (r0, r1), (c0, c1), cropped


def clip_bbox(pixels: DataFrame, grid: GridSpec, bbox) -> tuple[DataFrame, GridSpec]:
    """Crop to a box in EPSG:4326 by the pixel-centre rule; filters reach the scan.

    In another system the box is a shape with bent sides: the window is the envelope of its
    outline, and pixels whose centre lies outside the box become NULL. They are tested by
    taking the centre back to degrees, so the bent sides need no approximation.
    """
    rows, cols, cropped = clip_window(grid, outline_envelope(bbox, 4326, grid.srid))
    cut = raster_subset(pixels, rows, cols)
    if grid.srid == 4326:
        return cut, cropped
    x = f"({number(cropped.x0)} + (col + 0.5D) * {number(cropped.px)})"
    y = f"({number(cropped.y1)} - (row + 0.5D) * {number(cropped.py)})"
    west, south, east, north = map(float, bbox)
    centre = F.expr(crs.transform_xy(x, y, grid.srid, 4326))
    inside = centre["x"].between(west, east) & centre["y"].between(south, north)
    return cut.withColumn("value", F.when(inside, F.col("value"))), cropped


def outline_envelope(bbox, source: int, target: int, steps: int = 64):
    """Envelope of a box's outline in another system, its sides cut into ``steps`` (driver-side job parameter)."""
    if source == target:
        return tuple(bbox)
    from pyspark.sql import SparkSession

    x0, y0, x1, y1 = map(float, bbox)
    parts = [i / steps for i in range(steps + 1)]
    outline = [(x0 + (x1 - x0) * t, y) for t in parts for y in (y0, y1)] + [(x, y0 + (y1 - y0) * t) for t in parts for x in (x0, x1)]
    spark = SparkSession.getActiveSession()
    points = spark.createDataFrame(outline, "x double, y double").select(F.expr(crs.transform_xy("x", "y", source, target)).alias("p"))
    return tuple(points.agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first())


def crop_all_touched(pixels: DataFrame, grid: GridSpec, aoi: DataFrame, nodata: float = 255.0) -> DataFrame:
    """Crop to the envelope of an area of interest; pixels its polygon does not touch become nodata.

    ``aoi`` is a table with one polygon in the normal form. Every pixel of the cropped
    window is kept.
    """
    touched = cover_cells(aoi.select("geometry"), grid).select("row", "col").distinct().withColumn("_in", F.lit(True))
    window = touched.agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    cut = pixels.where(F.col("row").between(window[0], window[1]) & F.col("col").between(window[2], window[3]))
    return (
        cut.join(touched, ["row", "col"], "left")
        .withColumn("value", F.when(F.col("_in"), F.col("value")).otherwise(F.lit(float(nodata))))
        .select(*pixels.columns)
    )


# ---------------------------------------------------------------- mosaic and resampling

def overlap_boxes(meta: DataFrame) -> DataFrame:
    """raster_id and ``boxes``: the parts of each raster (rows and columns of its own, half-open) that another one reaches too.

    ``meta`` holds ``raster_id, x0, y1, px, py, width, height``; rasters meet through ``envelope_join``, not pair by pair.
    """
    shapes = meta.select(
        "raster_id", "x0", "y1", "px", "py", "width", "height",
        F.expr(geo.box_polygon("x0", "y1 - height * py", "x0 + width * px", "y1")).alias("geometry"),
    )
    others = shapes.select(
        F.col("raster_id").alias("other"), F.col("x0").alias("ox0"), F.col("y1").alias("oy1"),
        (F.col("x0") + F.col("width") * F.col("px")).alias("ox1"), (F.col("y1") - F.col("height") * F.col("py")).alias("oy0"),
        F.col("geometry").alias("aoi"),
    )
    least = meta.agg(F.min(F.least(F.col("width") * F.col("px"), F.col("height") * F.col("py")))).first()[0]
    if not least:
        return meta.select("raster_id", F.array().cast("array<struct<r0:int,r1:int,c0:int,c1:int>>").alias("boxes")).where(F.lit(False))
    pairs = envelope_join(shapes, others, float(least)).where("raster_id <> other")

    def clamp(value: str, size: str) -> str:
        return f"CAST(greatest(0, least({size}, rint({value}))) AS INT)"

    boxed = pairs.select("raster_id", F.expr(f"""named_struct(
        'r0', {clamp("(y1 - oy1) / py", "height")}, 'r1', {clamp("(y1 - oy0) / py", "height")},
        'c0', {clamp("(ox0 - x0) / px", "width")}, 'c1', {clamp("(ox1 - x0) / px", "width")})""").alias("box"))
    return boxed.where("box.r0 < box.r1 AND box.c0 < box.c1").groupBy("raster_id").agg(F.collect_set("box").alias("boxes"))


def mosaic(pixels: DataFrame, meta: DataFrame, raster_id: str = "mosaic") -> DataFrame:
    """Merge rasters of equal resolution; where they overlap, the one first in ``file_order`` wins.

    ``meta`` holds ``raster_id, x0, y1, px, py, file_order``. NULL pixels never win. With ``width`` and
    ``height`` too, the overlaps are found among the rasters first, and only pixels in one are
    shuffled; the others pass as they are.
    """
    union = meta.agg(F.min("x0").alias("_west"), F.max("y1").alias("_north")).first()
    west, north = F.lit(union["_west"]), F.lit(union["_north"])
    shifts = meta.select(
        "raster_id",
        "file_order",
        F.rint((north - F.col("y1")) / F.col("py")).cast("int").alias("_dr"),
        F.rint((F.col("x0") - west) / F.col("px")).cast("int").alias("_dc"),
    )
    indexed = {"width", "height"} <= set(meta.columns)
    if indexed:
        shifts = shifts.join(overlap_boxes(meta), "raster_id", "left")
    shared = F.exists(F.coalesce("boxes", F.array().cast("array<struct<r0:int,r1:int,c0:int,c1:int>>")), lambda b: (
        (F.col("row") >= b["r0"]) & (F.col("row") < b["r1"]) & (F.col("col") >= b["c0"]) & (F.col("col") < b["c1"])
    )) if indexed else F.lit(True)
    placed = pixels.where(F.col("value").isNotNull()).join(broadcast_if_small(shifts) if indexed else shifts, "raster_id")
    # before the pixels move, as the boxes count from their raster's corner
    moved = placed.withColumn("_shared", shared).select(
        "band",
        (F.col("row") + F.col("_dr")).alias("row"),
        (F.col("col") + F.col("_dc")).alias("col"),
        "value",
        "file_order",
        "_shared",
    )
    merged = moved.where("_shared").groupBy("band", "row", "col").agg(F.min_by("value", "file_order").alias("value"))
    if indexed:
        merged = merged.unionByName(moved.where("NOT _shared").select("band", "row", "col", "value"))
    return merged.select(F.lit(raster_id).alias("raster_id"), *PIXEL_COLUMNS[1:])


def _resample_axis(df: DataFrame, axis: str, size: Column, target: Column) -> DataFrame:
    """Split a pixel over the target cells it overlaps; overlaps are whole numbers of 1/size."""
    i, n, k = F.col(axis).cast("bigint"), size.cast("bigint"), target.cast("bigint")
    sized = df.withColumns({"_i": i, "_n": n, "_k": k})
    spread = sized.withColumn(
        "_t", F.explode(F.sequence(F.expr("(_i * _k) div _n"), F.expr("((_i + 1) * _k - 1) div _n")))
    )
    overlap = F.least(F.expr("(_i + 1) * _k"), F.expr("(_t + 1) * _n")) - F.greatest(
        F.expr("_i * _k"), F.expr("_t * _n")
    )
    return spread.withColumn("_w", F.col("_w") * overlap).withColumn(axis, F.col("_t").cast("int")).drop(
        "_i", "_n", "_k", "_t"
    )


def block_mean(pixels: DataFrame, sizes: DataFrame) -> DataFrame:
    """Area-weighted mean on a coarser grid.

    ``sizes`` holds ``raster_id, height, width, out_height, out_width``. Where a target
    cell border cuts a pixel, the pixel counts with the exact share on either side.
    """
    sized = pixels.where(F.col("value").isNotNull()).join(broadcast_if_small(sizes), "raster_id").withColumn(
        "_w", F.lit(1).cast("bigint")
    )
    split = _resample_axis(sized, "row", F.col("height"), F.col("out_height"))
    split = _resample_axis(split, "col", F.col("width"), F.col("out_width"))
    return split.groupBy("raster_id", "band", "row", "col").agg(
        (F.sum(F.col("value") * F.col("_w")) / F.sum("_w")).alias("value")
    )


def canopy_block(resolution: float, pixel_size: float) -> int:
    """Source pixels per target pixel, at least 1."""
    return max(int(resolution / 111035 / pixel_size), 1)


def block_positive_count(pixels: DataFrame, extents: DataFrame, block: int, mode: str = "centred") -> DataFrame:
    """Pixels above 0 in the block-sized window around every ``block``-th pixel.

    Windows sampled at that spacing do not overlap, so each pixel belongs to one sample
    and a single aggregation replaces the sliding sum. ``aligned`` counts in the plain
    blocks instead.
    """
    if mode not in ("centred", "aligned"):
        raise ValueError("mode is 'centred' or 'aligned'")
    shift = block // 2 if mode == "centred" else 0

    def sample(axis: str) -> Column:
        return F.expr(f"CAST(({axis} + {shift}) div {block} AS INT)")

    def samples(size: str) -> Column:
        return F.expr(f"({size} + {block - 1}) div {block}")

    keyed = pixels.join(broadcast_if_small(extents), "raster_id").select(
        "raster_id", sample("row").alias("row"), sample("col").alias("col"), "value",
        samples("height").alias("_h"), samples("width").alias("_w"),
    )
    inside = keyed.where((F.col("row") < F.col("_h")) & (F.col("col") < F.col("_w")))
    return inside.groupBy("raster_id", "row", "col").agg(F.count_if(F.col("value") > 0).alias("count"))


def resample_canopy(pixels: DataFrame, extents: DataFrame, block: int, mode: str = "centred") -> DataFrame:
    """Average height and number of canopy pixels on the coarser grid."""
    extents = cut_lineage(extents)

    def reduced(size: str) -> Column:
        return F.expr(f"CAST(({size} + {block - 1}) div {block} AS INT)")

    sizes = extents.select(
        "raster_id", "height", "width", reduced("height").alias("out_height"), reduced("width").alias("out_width")
    )
    average = block_mean(pixels, sizes).select("raster_id", "row", "col", F.col("value").alias("average"))
    count = block_positive_count(pixels, extents, block, mode)
    return average.join(count, ["raster_id", "row", "col"], "full").withColumn(
        "count", F.coalesce("count", F.lit(0))
    )


def reproject(pixels: DataFrame, source: GridSpec, target: GridSpec, method: str = "nearest") -> DataFrame:
    """Pull every target cell from the source raster; cells that fall outside are absent."""
    spark = pixels.sparkSession
    cells = target.cells(spark)
    there = crs.transform_xy(target.centre_x("col"), target.centre_y("row"), target.srid, source.srid)
    placed = cells.withColumn("_p", F.expr(there)).select(
        "row",
        "col",
        ((F.col("_p.x") - F.lit(source.x0)) / F.lit(source.px)).alias("_u"),
        ((F.lit(source.y1) - F.col("_p.y")) / F.lit(source.py)).alias("_v"),
    )
    values = pixels.select("raster_id", "band", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    if method == "nearest":
        wanted = placed.select(
            "row", "col", F.floor("_v").cast("int").alias("_r"), F.floor("_u").cast("int").alias("_c")
        )
        return wanted.join(values, ["_r", "_c"]).select(*PIXEL_COLUMNS)
    if method != "bilinear":
        raise ValueError("method is 'nearest' or 'bilinear'")
    inside = placed.where(
        (F.col("_u") >= 0) & (F.col("_u") < source.width) & (F.col("_v") >= 0) & (F.col("_v") < source.height)
    )
    left, top = F.floor(F.col("_u") - 0.5).cast("int"), F.floor(F.col("_v") - 0.5).cast("int")
    fx, fy = F.col("_u") - 0.5 - left, F.col("_v") - 0.5 - top
    corners = F.array(*[
        F.struct((top + dr).alias("_r"), (left + dc).alias("_c"), (wy * wx).alias("_w"))
        for dr, wy in ((0, 1 - fy), (1, fy))
        for dc, wx in ((0, 1 - fx), (1, fx))
    ])
    wanted = inside.select("row", "col", F.inline(corners)).where(F.col("_w") > 0)
    return (
        wanted.join(values.where(F.col("value").isNotNull()), ["_r", "_c"])
        .groupBy("raster_id", "band", "row", "col")
        .agg((F.sum(F.col("value") * F.col("_w")) / F.sum("_w")).alias("value"))
    )


def clip_reproject(
    pixels: DataFrame, source: GridSpec, bbox, target: GridSpec, method: str = "nearest"
) -> DataFrame:
    """Clip in the source system to a box given in the target system, then reproject.

    The window is the envelope of the box's outline, as its sides may lean or bend there; where neighbours
    are weighed it is a pixel wider on each side.
    """
    envelope = outline_envelope(bbox, target.srid, source.srid)
    rows, cols, cropped = clip_window(source, envelope, margin=int(method == "bilinear"))
    return reproject(raster_subset(pixels, rows, cols), cropped, target, method)


# ---------------------------------------------------------------- summaries

def raster_summary(pixels: DataFrame) -> DataFrame:
    """Mean, extremes, population deviation and exact percentiles 5, 95 and 99.5 per band."""
    keys = ["raster_id", "band"]
    value = null_if_nan(F.col("value").cast("double"))
    moments = pixels.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.stddev_pop(value).alias("std"),
    )
    percentiles = exact_percentiles(pixels, keys, "value", {"p05": 0.05, "p95": 0.95, "p995": 0.995})
    # NULL-safe, so that no key filter reaches only one of the two uses of the counted values
    right = percentiles.withColumnsRenamed({"raster_id": "_r", "band": "_b"})
    same = moments["raster_id"].eqNullSafe(right["_r"]) & moments["band"].eqNullSafe(right["_b"])
    return moments.join(right, same).drop("_r", "_b")


def raster_histogram(pixels: DataFrame, edges: int = 40) -> DataFrame:
    """Share of all pixels per unit bin ``[0,1) .. [edges-2, edges-1]``, the last one closed.

    The share is of all pixels, including those outside every bin. Empty bins have no row.
    """
    keys = ["raster_id", "band"]
    top = edges - 1
    v = F.col("value")
    bin_ = F.when((v >= 0) & (v < top), F.floor(v).cast("int")).when(v == top, F.lit(top - 1))
    counts = pixels.groupBy(*keys, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    # at most ``edges`` rows per band are left
    total = F.sum("_n").over(Window.partitionBy(*keys))
    return counts.withColumn("_total", total).where(F.col("bin").isNotNull()).select(
        *keys, "bin", (F.col("_n") / F.col("_total")).alias("fraction")
    )
