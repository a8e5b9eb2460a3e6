"""Checked queries: pixel tables, neighbourhoods, texture, distance, resampling and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraquilt.functions.indices import BAND_MAPS, INDEX_NAMES
from terraquilt.grid import GridSpec
from terraquilt.operators import cover as cv, distance as ds, focal as fc, raster as rs, rasterize as rz
from terraquilt.operators import sampling as sm, texture as tx, warp as wp
from terraquilt.plans.fixtures import BBOX, load, num, pixel_height, with_inputs, zones
from terraquilt.plans.registry import QUERIES, query, rounded
from terraquilt.plans.series_queries import plane_sql
from terraquilt.session import fresh_path, small_table
from terraquilt.sources import readers, writers

KEYS = ("raster_id", "band", "row", "col")


def bands(spark, raster_id, *names):
    return rz.band_table(spark, raster_id, list(names))


# ---------------------------------------------------------------- tiles and stacks

@query("raster_tiles_scan", with_inputs("holes") + """
    SELECT raster_id, band, row, col, value FROM holes""")
def raster_tiles_scan(spark, sf_dir):
    path = writers.write_raster(load(spark, sf_dir, "holes"), fresh_path(spark, "tiles"), 64)
    return readers.tiles_to_pixels(spark.read.parquet(path), 64).select(*KEYS, "value")


@query("raster_stack_sink", with_inputs("pixels", "sources") + """
    SELECT 'stack' AS raster_id, 1 AS band, 'signal' AS name, row, col, value FROM pixels
    UNION ALL SELECT 'stack', 2, 'source', row, col, value FROM sources""")
def raster_stack_sink(spark, sf_dir):
    layers = {"signal": load(spark, sf_dir, "pixels"), "source": load(spark, sf_dir, "sources")}
    stacked, names = writers.stack_bands(layers, "stack")
    path = writers.write_raster(stacked, fresh_path(spark, "stack"))
    back = readers.tiles_to_pixels(spark.read.parquet(path), 256)
    named = back.join(bands(spark, "stack", *names.values()), ["raster_id", "band"])
    return named.select("raster_id", "band", "name", "row", "col", "value")


@query("raster_copy_described", with_inputs("holes") + """
    SELECT raster_id, row, col, value, 'aod' AS name FROM holes""")
def raster_copy_described(spark, sf_dir):
    pixels, meta = rs.copy_described(load(spark, sf_dir, "holes"), bands(spark, "grid", "value"), "aod")
    path = writers.write_raster(pixels, fresh_path(spark, "copy"))
    back = readers.tiles_to_pixels(spark.read.parquet(path), 256)
    return back.join(meta, ["raster_id", "band"]).select("raster_id", "row", "col", "value", "name")


@query("raster_metadata", with_inputs("pixels") + f"""
    SELECT 'grid' AS raster_id, max(col) + 1 AS width, max(row) + 1 AS height, {num(-74.01)} AS xmin,
           round({num(40.88)} - (max(row) + 1) * {num(0.001)}, 6) AS ymin,
           round({num(-74.01)} + (max(col) + 1) * {num(0.0015)}, 6) AS xmax, {num(40.88)} AS ymax,
           'a,b' AS bands, true AS srid_missing FROM pixels""")
def raster_metadata(spark, sf_dir):
    meta = rs.raster_extents(load(spark, sf_dir, "pixels")).withColumns({
        "srid": F.lit(0), "x0": F.lit(-74.01), "y1": F.lit(40.88), "px": F.lit(0.0015), "py": F.lit(0.001),
    })
    described = rs.raster_metadata(meta, bands(spark, "grid", "a", "b"))
    flat = described.withColumn("bands", F.array_join("bands", ",")).drop("srid", "res_x", "res_y")
    return rounded(flat)


# ---------------------------------------------------------------- band maths

@query("band_align_join", with_inputs("pixels", "sources") + """
    SELECT p.row, p.col, p.value AS a, s.value AS b FROM pixels AS p JOIN sources AS s USING (row, col)""")
def band_align_join(spark, sf_dir):
    left = load(spark, sf_dir, "pixels").select("row", "col", F.col("value").alias("a"))
    right = load(spark, sf_dir, "sources").select("row", "col", F.col("value").alias("b"))
    return rs.align_bands(left, right)


def nd(a: str, b: str, eps: str = " + 1e-10") -> str:
    return f"greatest(-1, least(1, ({a} - {b}) / ({a} + {b}{eps})))"


_SAVI = "greatest(-1.5, least(1.5, 1.5 * (nir - red) / (nir + red + 0.5 + 1e-10)))"
_WATER = f"({_SAVI} + {nd('green', 'swir16')})"
INDEX_SQL = {
    "ndvi": nd("nir", "red", ""),
    "evi": "greatest(-1, least(1, 2.5 * (nir - red) / (nir + 6 * red - 7.5 * blue + 1 + 1e-10)))",
    "savi": _SAVI,
    "gndvi": nd("nir", "green"),
    "arvi": nd("nir", "(2 * red - blue)"),
    "msavi": "greatest(0, least(1, (2 * nir + 1 - sqrt(greatest(0, pow(2 * nir + 1, 2) - 8 * (nir - red)))) / 2))",
    "ndwi": nd("green", "nir", ""),
    "awei_nsh": "4 * (green - swir16) - (0.25 * nir + 2.75 * swir22)",
    "awei_sh": "green + 2.5 * nir - 1.5 * (swir16 + swir22) - 0.25 * blue",
    "ndsi": nd("green", "swir16"),
    "nbr": nd("nir", "swir22"),
    "si": nd("swir16", "blue"),
    "ndbi": nd("swir16", "nir"),
    "ui": nd("swir16", "red"),
    "ibi": nd(nd("swir16", "nir"), _WATER),
    "albedo": "greatest(0, least(1, (0.356 * blue + 0.130 * red + 0.373 * nir + 0.085 * swir16 "
              "+ 0.072 * swir22 - 0.018) / 1.016))",
}


@query("spectral_indices", with_inputs("spectral") + " SELECT row, col, "
       + ", ".join(f"round({e}, 9) + 0.0 AS {n}" for n, e in INDEX_SQL.items()) + " FROM spectral")
def spectral_indices(spark, sf_dir):
    return rounded(rs.index_bands(load(spark, sf_dir, "spectral")).select("row", "col", *INDEX_NAMES), 9)


_INDICES = ", ".join(f"round({e}, 9) + 0.0 AS {n}" for n, e in INDEX_SQL.items())


@query("sensor_indices", with_inputs("spectral") + f"""
    SELECT 'landsat_8' AS sensor, row, col, {_INDICES} FROM spectral
    UNION ALL SELECT 'sentinel_2', row, col, {_INDICES} FROM spectral""")
def sensor_indices(spark, sf_dir):
    """From a multi-band pixel table of each sensor, through its band numbers; bands of no use are there too."""
    scene = load(spark, sf_dir, "spectral")
    parts = []
    for sensor, numbers in BAND_MAPS.items():
        entries = [F.struct(F.lit(b).alias("band"), F.col(n).alias("value")) for n, b in numbers.items()]
        entries += [F.struct(F.lit(b).alias("band"), F.lit(-1.0).alias("value")) for b in (7, 9, 10)]
        pixels = scene.select("raster_id", "row", "col", F.inline(F.array(*entries))).select(*rs.PIXEL_COLUMNS)
        wide = rs.bands_to_columns(rs.sensor_indices(pixels, sensor), dict(enumerate(INDEX_NAMES, start=1)))
        parts.append(wide.select(F.lit(sensor).alias("sensor"), "row", "col", *INDEX_NAMES))
    return rounded(parts[0].unionByName(parts[1]), 9)


@query("height_width_ratio", with_inputs("spectral") + """
    SELECT row, col, round(CASE WHEN blue % 3 = 0 THEN -1 ELSE red / (blue % 3 * 10) END, 6) AS var,
           round(green / (900 * 10.764), 6) AS building_area_per_pixel FROM spectral""")
def height_width_ratio(spark, sf_dir):
    cells = load(spark, sf_dir, "spectral")
    built = cells.select("row", "col", F.col("red").alias("building_height"), F.col("green").alias("building_area"))
    roads = cells.select("row", "col", (F.col("blue") % 3 * 10).alias("street_width"))
    return rounded(rs.height_width_ratio(built, roads, 30))


@query("quantize_16", with_inputs("holes") + """
    SELECT row, col, CAST(floor((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER () + 1) * 16)
           AS INT) AS level FROM holes""")
def quantize_16(spark, sf_dir):
    return tx.quantise_16(load(spark, sf_dir, "holes")).select("row", "col", "level")


# ---------------------------------------------------------------- neighbourhoods

def neighbours_sql(source: str, size: int, aggregates: str) -> str:
    """Brute force: every offset joined to every cell."""
    return f"""
    offsets AS (SELECT a.i AS dr, b.i AS dc FROM range(-{size}, {size} + 1) AS a(i), range(-{size}, {size} + 1) AS b(i)),
    wanted AS (SELECT p.row, p.col, p.row + dr AS r, p.col + dc AS c FROM {source} AS p, offsets),
    near AS (SELECT w.row, w.col, q.value FROM wanted AS w JOIN {source} AS q ON q.row = w.r AND q.col = w.c)
    SELECT row, col, {aggregates} FROM near GROUP BY row, col"""


def focal_query(source: str, size: int, operation: str, dense: bool):
    def run(spark, sf_dir):
        df = fc.focal_statistics(load(spark, sf_dir, source), size, (operation,), dense=dense)
        return rounded(df.select("row", "col", operation), 9)

    return run


for _name, _source, _size, _op, _sql in (
    ("focal_mean", "holes", 1, "mean", "avg(value)"),
    ("focal_std", "holes", 2, "std_dev", "stddev_pop(value)"),
    ("focal_median", "holes", 1, "median", "median(value)"),
    ("focal_mean_15x15", "pixels", 7, "mean", "avg(value)"),
):
    query(_name, with_inputs(_source) + "," + neighbours_sql(_source, _size, f"round({_sql}, 9) AS {_op}"))(
        focal_query(_source, _size, _op, _source == "pixels")
    )


FOCAL_BANDS_SQL = with_inputs("spectral") + """,
    long AS (SELECT row, col, 'red' AS b, red AS value FROM spectral
             UNION ALL SELECT row, col, 'nir', nir FROM spectral),
    offsets AS (SELECT a.i AS dr, b.i AS dc FROM range(-1, 2) AS a(i), range(-1, 2) AS b(i)),
    wanted AS (SELECT b, row, col, row + dr AS r, col + dc AS c FROM long, offsets)
    SELECT w.b || '_mean_3x3' AS name, w.row, w.col, round(avg(q.value), 9) AS value
    FROM wanted AS w JOIN long AS q ON q.row = w.r AND q.col = w.c AND q.b = w.b GROUP BY ALL"""


@query("focal_bands", FOCAL_BANDS_SQL)
def focal_bands(spark, sf_dir):
    pixels = rz.bands_to_pixels(load(spark, sf_dir, "spectral"), "landsat_8", ["red", "nir"])
    smoothed, meta = fc.focal_bands(pixels, bands(spark, "landsat_8", "red", "nir"), "mean", 1, dense=True)
    return rounded(smoothed.join(meta, ["raster_id", "band"]).select("name", "row", "col", "value"), 9)


def texture_sql(source: str, size: int) -> str:
    """All level pairs of every window, joined one by one."""
    return with_inputs(source) + f""",
    q AS (SELECT row, col, CAST(floor((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER () + 1) * 16)
          AS INT) AS v FROM {source}),
    pairs AS (SELECT a.row, a.col, a.v AS i, b.v AS j FROM q AS a JOIN q AS b ON b.row = a.row + 1 AND b.col = a.col + 1),
    offsets AS (SELECT a.i AS dr, b.i AS dc FROM range(-{size}, {size}) AS a(i), range(-{size}, {size}) AS b(i)),
    wanted AS (SELECT q.row, q.col, q.row + dr AS r, q.col + dc AS c FROM q, offsets),
    hits AS (SELECT w.row, w.col, p.i, p.j FROM wanted AS w JOIN pairs AS p ON p.row = w.r AND p.col = w.c),
    both_ways AS (SELECT row, col, i, j FROM hits UNION ALL SELECT row, col, j, i FROM hits),
    counted AS (SELECT row, col, i, j, count(*) AS n FROM both_ways GROUP BY ALL),
    p AS (SELECT row, col, i, j, n / sum(n) OVER (PARTITION BY row, col) AS p FROM counted),
    m AS (SELECT row, col, sum(p * i) AS mu FROM p GROUP BY row, col),
    s AS (SELECT row, col, sum(p * (i - j) * (i - j)) AS contrast, sum(p * abs(i - j)) AS dissimilarity,
            sum(p / (1 + (i - j) * (i - j))) AS homogeneity, sum(p * p) AS asm_,
            sum(p * (i - mu) * (j - mu)) AS cov, sum(p * (i - mu) * (i - mu)) AS var
          FROM p JOIN m USING (row, col) GROUP BY row, col)"""


TEXTURE_COLUMNS = """round(coalesce(contrast, 0), 9) AS contrast, round(coalesce(dissimilarity, 0), 9) AS dissimilarity,
    round(coalesce(homogeneity, 0), 9) AS homogeneity, round(coalesce(sqrt(asm_), 0), 9) AS energy,
    round(CASE WHEN var IS NULL OR var < 1e-12 THEN 1 ELSE cov / var END, 9) + 0.0 AS correlation,
    round(coalesce(asm_, 0), 9) AS "ASM" """


@query("glcm_texture", texture_sql("holes", 2) + f"""
    SELECT row, col, {TEXTURE_COLUMNS} FROM q LEFT JOIN s USING (row, col)""")
def glcm_texture(spark, sf_dir):
    texture = tx.glcm_texture(load(spark, sf_dir, "holes"), 2)
    return rounded(texture.select("row", "col", *tx.PROPERTIES), 9)


@query("neighbourhood_features", texture_sql("pixels", 1) + f""",
    t AS (SELECT row, col, {TEXTURE_COLUMNS} FROM q LEFT JOIN s USING (row, col)),
    nine AS (SELECT a.i AS dr, b.i AS dc FROM range(-1, 2) AS a(i), range(-1, 2) AS b(i)),
    around AS (SELECT x.row, x.col, y.value FROM (SELECT row, col, row + dr AS r, col + dc AS c FROM pixels, nine) AS x
               JOIN pixels AS y ON y.row = x.r AND y.col = x.c),
    f AS (SELECT row, col, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS std_dev FROM around
          GROUP BY row, col)
    SELECT 'value_' || op || '_3x3' AS name, row, col, v AS value FROM
      (UNPIVOT (SELECT row, col, contrast, dissimilarity, homogeneity, energy, correlation, "ASM", mean, std_dev
                FROM t JOIN f USING (row, col))
       ON contrast, dissimilarity, homogeneity, energy, correlation, "ASM", mean, std_dev INTO NAME op VALUE v)""")
def neighbourhood_features(spark, sf_dir):
    pixels = load(spark, sf_dir, "pixels").withColumn("raster_id", F.replace("raster_id", F.lit("grid"), F.lit("landsat_8")))
    features = fc.neighbourhood_features(pixels, bands(spark, "landsat_8", "value"), 1, dense=True)
    return rounded(features.select("name", "row", "col", "value"), 9)


# ---------------------------------------------------------------- distance

def octile_sql(cells: str, sources: str) -> str:
    """Brute force: least octile distance over all sources."""
    dr, dc = "abs(p.row - s.row)", "abs(p.col - s.col)"
    return f"""SELECT p.row, p.col,
        round(min(greatest({dr}, {dc}) + (sqrt(2) - 1) * least({dr}, {dc})), 6) AS distance
        FROM {cells} AS p, {sources} AS s GROUP BY p.row, p.col"""


@query("distance_transform", with_inputs("sources") + """,
    marked AS (SELECT row, col FROM sources WHERE value > 0) """ + octile_sql("sources", "marked"))
def distance_transform(spark, sf_dir):
    cells = load(spark, sf_dir, "sources")
    # a pixel without row is none, and must not become a source at (0, 0)
    nameless = cells.where("value > 0").withColumn("row", F.lit(None).cast("int"))
    distances = ds.distance_transform(cells.unionByName(nameless), block=32)
    return rounded(distances.select("row", "col", "distance"))


ZONE_BANDS = tuple(rz.ZONE_COUNT_BANDS)


@query("zoning_distance", with_inputs("zone_counts") + "," + ", ".join(
    f"{b} AS (WITH m AS (SELECT row, col FROM zone_counts WHERE {b} > 0) {octile_sql('zone_counts', 'm')})"
    for b in ZONE_BANDS) + " UNION ALL ".join(
    f"SELECT '{b}_distance' AS name, row, col, distance AS value FROM {b}" if i else
    f" SELECT '{b}_distance' AS name, row, col, distance AS value FROM {b} " for i, b in enumerate(ZONE_BANDS)))
def zoning_distance(spark, sf_dir):
    pixels = rz.bands_to_pixels(load(spark, sf_dir, "zone_counts"), "nyzd", list(ZONE_BANDS))
    distances, meta = ds.zoning_distance(pixels, bands(spark, "nyzd", *ZONE_BANDS), block=32)
    return rounded(distances.join(meta, ["raster_id", "band"]).select("name", "row", "col", "value"))


# ---------------------------------------------------------------- resampling

BLOCK = 7
COUNT_SQL = f"""
    extent AS (SELECT max(row) + 1 AS h, max(col) + 1 AS w FROM holes),
    windows AS (SELECT r.i AS row, c.i AS col FROM extent, range(0, (SELECT (h + {BLOCK} - 1) // {BLOCK} FROM extent)) AS r(i),
                range(0, (SELECT (w + {BLOCK} - 1) // {BLOCK} FROM extent)) AS c(i)),
    inside AS (SELECT w.row, w.col, count(*) FILTER (p.value > 20) AS n FROM windows AS w JOIN holes AS p
        ON p.row BETWEEN w.row * {BLOCK} - {BLOCK} // 2 AND w.row * {BLOCK} - {BLOCK} // 2 + {BLOCK} - 1
        AND p.col BETWEEN w.col * {BLOCK} - {BLOCK} // 2 AND w.col * {BLOCK} - {BLOCK} // 2 + {BLOCK} - 1
        GROUP BY ALL)"""
MEAN_SQL = """
    shares AS (SELECT t.row, t.col, p.value,
        (least(p.row + 1, (t.row + 1) * H) - greatest(p.row, t.row * H))
        * (least(p.col + 1, (t.col + 1) * W) - greatest(p.col, t.col * W)) AS share
        FROM targets AS t JOIN holes AS p ON p.row < (t.row + 1) * H AND p.row + 1 > t.row * H
          AND p.col < (t.col + 1) * W AND p.col + 1 > t.col * W),
    means AS (SELECT row, col, sum(value * share) / sum(share) AS mean FROM shares GROUP BY row, col)"""


def mean_sql(block: int) -> str:
    """Area shares in floating point, target cells of a fractional size."""
    return f"""
    size AS (SELECT max(row) + 1 AS h, max(col) + 1 AS w, (max(row) + {block}) // {block} AS oh,
             (max(col) + {block}) // {block} AS ow FROM holes),
    targets AS (SELECT CAST(r.i AS INT) AS row, CAST(c.i AS INT) AS col, h / oh AS H, w / ow AS W FROM size,
        range(0, (SELECT oh FROM size)) AS r(i), range(0, (SELECT ow FROM size)) AS c(i)),{
        MEAN_SQL.replace("* H", "* t.hh").replace("* W", "* t.ww")}""".replace("AS H,", "AS hh,").replace("AS W FROM", "AS ww FROM")


@query("block_mean", with_inputs("holes") + "," + mean_sql(6) + """
    SELECT row, col, round(mean, 9) AS value FROM means""")
def block_mean(spark, sf_dir):
    holes = load(spark, sf_dir, "holes")
    sizes = rs.raster_extents(holes).select("*", F.expr("(height + 5) div 6").alias("out_height"), F.expr("(width + 5) div 6").alias("out_width"))
    return rounded(rs.block_mean(holes, sizes).select("row", "col", "value"), 9)


@query("block_positive_count", with_inputs("holes") + "," + COUNT_SQL + """
    SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, n AS count FROM inside""")
def block_positive_count(spark, sf_dir):
    holes = load(spark, sf_dir, "holes")
    shifted = holes.withColumn("value", F.col("value") - 20)
    return rs.block_positive_count(shifted, rs.raster_extents(holes), BLOCK).select("row", "col", "count")


@query("resample_canopy", with_inputs("holes") + "," + COUNT_SQL.replace("p.value > 20", "p.value > 0") + "," + mean_sql(BLOCK) + """
    SELECT m.row, m.col, round(mean, 9) AS average, coalesce(n, 0) AS count
    FROM means AS m LEFT JOIN inside USING (row, col)""")
def resample_canopy(spark, sf_dir):
    holes = load(spark, sf_dir, "holes")
    canopy = rs.resample_canopy(holes, rs.raster_extents(holes), BLOCK)
    return rounded(canopy.select("row", "col", "average", "count"), 9)


# ---------------------------------------------------------------- mosaics, masks and crops

MOSAIC_PARTS = {"b_second": (40, 0, 2), "a_first": (0, 30, 1), "c_third": (80, 60, 3)}


@query("raster_mosaic", with_inputs("holes") + """,
    parts AS (SELECT * FROM (VALUES (40, 0, 2), (0, 30, 1), (80, 60, 3)) AS v(dr, dc, o)),
    moved AS (SELECT row + dr AS row, col + dc AS col, value + o * 1000 AS value, o FROM holes, parts),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY o) AS k FROM moved)
    SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, round(value, 6) AS value FROM ranked WHERE k = 1""")
def raster_mosaic(spark, sf_dir):
    holes = load(spark, sf_dir, "holes").drop("raster_id")
    parts = F.array(*[
        F.struct(F.lit(name).alias("raster_id"), F.lit(float(order * 1000)).alias("lift"))
        for name, (_, _, order) in MOSAIC_PARTS.items()
    ])
    pixels = holes.select("*", F.inline(parts)).withColumn("value", F.col("value") + F.col("lift")).drop("lift")
    meta = small_table(
        spark,
        [(n, -74.0 + c * 0.25, 40.0 - r * 0.5, 0.25, 0.5, o) for n, (r, c, o) in MOSAIC_PARTS.items()],
        "raster_id string, x0 double, y1 double, px double, py double, file_order int",
    )
    return rounded(rs.mosaic(pixels, meta).select("row", "col", "value"))


@query("apply_mask", with_inputs("pixels") + """
    SELECT row, col, CASE WHEN (row * 100 + col) % 6 = 0 THEN 255 ELSE value END AS value FROM pixels""")
def apply_mask(spark, sf_dir):
    pixels = load(spark, sf_dir, "pixels")
    mask = pixels.where("(row * 100 + col) % 3 = 0").withColumn(
        "value", F.expr("IF((row * 100 + col) % 6 = 0, 255, 0)")
    )
    return rs.apply_mask(pixels, mask).select("row", "col", "value")


@query("threshold_to_null", with_inputs("pixels") + """
    SELECT row, col, CASE WHEN value > 200 THEN NULL ELSE value END AS value FROM pixels""")
def threshold_to_null(spark, sf_dir):
    return rs.threshold_to_null(load(spark, sf_dir, "pixels")).select("row", "col", "value")


@query("raster_subset", with_inputs("pixels") + """
    SELECT row - 3 AS row, col - 20 AS col, value FROM pixels WHERE row >= 3 AND row < 60 AND col >= 20 AND col < 75""")
def raster_subset(spark, sf_dir):
    return rs.raster_subset(load(spark, sf_dir, "pixels"), (3, 60), (20, 75)).select("row", "col", "value")


def pixel_grid(spark, sf_dir) -> GridSpec:
    """Grid of the pixel table: 100 columns over the study area, as many rows as there are."""
    height = pixel_height(spark, sf_dir)
    return GridSpec(-74.02, 40.89, 0.0018, 0.0015, 100, height)


CLIP_BOX = (-74.0, 40.75, -73.9, 40.8841)


@query("raster_clip_bbox", with_inputs("pixels") + f"""
    SELECT row - min(row) OVER () AS row, col - min(col) OVER () AS col, value FROM (
      SELECT *, {num(-74.02)} + (col + 0.5) * {num(0.0018)} AS x, {num(40.89)} - (row + 0.5) * {num(0.0015)} AS y
      FROM pixels)
    WHERE x BETWEEN {num(CLIP_BOX[0])} AND {num(CLIP_BOX[2])} AND y BETWEEN {num(CLIP_BOX[1])} AND {num(CLIP_BOX[3])}""")
def raster_clip_bbox(spark, sf_dir):
    clipped, _ = rs.clip_bbox(load(spark, sf_dir, "pixels"), pixel_grid(spark, sf_dir), CLIP_BOX)
    return clipped.select("row", "col", "value")


TRIANGLE = ((-74.001, 40.8861), (-73.87, 40.8877), (-73.95, 40.7603))


@query("crop_all_touched", with_inputs("pixels") + f""",
    t AS (SELECT {", ".join(f"{num(x)} AS x{i}, {num(y)} AS y{i}" for i, (x, y) in enumerate(TRIANGLE))}),
    boxes AS (SELECT row, col, value, {num(-74.02)} + col * {num(0.0018)} AS cx0, {num(-74.02)} + (col + 1) * {num(0.0018)} AS cx1,
              {num(40.89)} - (row + 1) * {num(0.0015)} AS cy0, {num(40.89)} - row * {num(0.0015)} AS cy1 FROM pixels),
    sides AS (SELECT row, col, value, cx0, cx1, cy0, cy1, ax, ay, bx, b_y FROM boxes, (
        SELECT x0 AS ax, y0 AS ay, x1 AS bx, y1 AS b_y FROM t UNION ALL SELECT x1, y1, x2, y2 FROM t
        UNION ALL SELECT x2, y2, x0, y0 FROM t) AS e),
    tested AS (SELECT row, col, any_value(value) AS value, bool_and(
        greatest(-(bx - ax) * (cy0 - ay) + (b_y - ay) * (cx0 - ax), -(bx - ax) * (cy1 - ay) + (b_y - ay) * (cx0 - ax),
                 -(bx - ax) * (cy0 - ay) + (b_y - ay) * (cx1 - ax), -(bx - ax) * (cy1 - ay) + (b_y - ay) * (cx1 - ax)) >= 0)
        AND bool_and(cx1 >= {num(min(x for x, _ in TRIANGLE))} AND cx0 <= {num(max(x for x, _ in TRIANGLE))}
        AND cy1 >= {num(min(y for _, y in TRIANGLE))} AND cy0 <= {num(max(y for _, y in TRIANGLE))}) AS touched
        FROM sides GROUP BY row, col),
    win AS (SELECT min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM tested WHERE touched)
    SELECT row, col, CASE WHEN touched THEN value ELSE 255 END AS value FROM tested, win
    WHERE row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1""")
def crop_all_touched(spark, sf_dir):
    from terraquilt.functions import geometry as geo

    ring = [(geo.number(x), geo.number(y)) for x, y in (*TRIANGLE, TRIANGLE[0])]
    aoi = spark.range(1).select(F.expr(geo.polygon(ring)).alias("geometry"))
    cropped = rs.crop_all_touched(load(spark, sf_dir, "pixels"), pixel_grid(spark, sf_dir), aoi)
    return cropped.select("row", "col", "value")


# ---------------------------------------------------------------- reprojection

R = 6378137.0


def mercator_grid(spark, sf_dir) -> GridSpec:
    return GridSpec(-8239000.0, 4993000.0, 160.0, 140.0, 100, pixel_height(spark, sf_dir), 3857)


def degree_grid(spark, sf_dir) -> GridSpec:
    """Target grid in degrees; as tall as the source, so the work grows with the table."""
    return GridSpec(-74.01, 40.8756, 0.0013, 0.0009, 110, pixel_height(spark, sf_dir), 4326)


TARGET_SQL = f"""
    target AS (SELECT r.i AS row, c.i AS col, {num(-74.01)} + (c.i + 0.5) * {num(0.0013)} AS lon,
               {num(40.8756)} - (r.i + 0.5) * {num(0.0009)} AS lat
               FROM range(0, (SELECT max(row) + 1 FROM pixels)) AS r(i), range(0, 110) AS c(i)),
    uv AS (SELECT row, col, ({num(R)} * radians(lon) - {num(-8239000.0)}) / 160 AS u,
           ({num(4993000.0)} - {num(R)} * asinh(tan(radians(lat)))) / 140 AS v FROM target)"""


# cuts columns on both sides and the first rows
REPROJECT_BOX = (-73.99, 40.0, -73.91, 40.8735)


@query("raster_clip_reproject", with_inputs("pixels") + f""", {TARGET_SQL}
    SELECT CAST(uv.row AS INT) AS row, CAST(uv.col AS INT) AS col, value FROM uv JOIN pixels AS p
      ON p.row = CAST(floor(v) AS INT) AND p.col = CAST(floor(u) AS INT)
    WHERE {num(-8239000.0)} + (p.col + 0.5) * 160 BETWEEN {num(R)} * radians({num(REPROJECT_BOX[0])}) AND {num(R)} * radians({num(REPROJECT_BOX[2])})
      AND {num(4993000.0)} - (p.row + 0.5) * 140 BETWEEN {num(R)} * asinh(tan(radians({num(REPROJECT_BOX[1])})))
      AND {num(R)} * asinh(tan(radians({num(REPROJECT_BOX[3])})))""")
def raster_clip_reproject(spark, sf_dir):
    source, target = mercator_grid(spark, sf_dir), degree_grid(spark, sf_dir)
    moved = rs.clip_reproject(load(spark, sf_dir, "pixels"), source, REPROJECT_BOX, target)
    return moved.select("row", "col", "value")


@query("reproject_bilinear", with_inputs("pixels") + f""", {TARGET_SQL},
    corners AS (SELECT row, col, floor(u - 0.5) AS c, floor(v - 0.5) AS r, u - 0.5 - floor(u - 0.5) AS fx,
        v - 0.5 - floor(v - 0.5) AS fy FROM uv
        WHERE u >= 0 AND u < 100 AND v >= 0 AND v < (SELECT max(row) + 1 FROM pixels)),
    four AS (SELECT row, col, r + dr AS r, c + dc AS c, (CASE dr WHEN 1 THEN fy ELSE 1 - fy END)
             * (CASE dc WHEN 1 THEN fx ELSE 1 - fx END) AS w FROM corners, range(0, 2) AS a(dr), range(0, 2) AS b(dc))
    SELECT CAST(f.row AS INT) AS row, CAST(f.col AS INT) AS col, round(sum(w * value) / sum(w), 4) AS value
    FROM four AS f JOIN pixels AS p ON p.row = CAST(f.r AS INT) AND p.col = CAST(f.c AS INT) GROUP BY f.row, f.col""")
def reproject_bilinear(spark, sf_dir):
    moved = rs.reproject(
        load(spark, sf_dir, "pixels"), mercator_grid(spark, sf_dir), degree_grid(spark, sf_dir), "bilinear"
    )
    return rounded(moved.select("row", "col", "value"), 4)


# ---------------------------------------------------------------- summaries

@query("raster_summary", with_inputs("holes") + """
    SELECT raster_id, band, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
           round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.05), 6) AS p05,
           round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.995), 6) AS p995
    FROM holes GROUP BY raster_id, band""")
def raster_summary(spark, sf_dir):
    return rounded(rs.raster_summary(load(spark, sf_dir, "holes")))


@query("raster_histogram", with_inputs("pixels") + """,
    b AS (SELECT CAST(CASE WHEN value >= 0 AND value < 39 THEN floor(value) WHEN value = 39 THEN 38 END AS INT) AS bin
          FROM pixels)
    SELECT bin, round(count(*) / (SELECT count(*) FROM b), 6) AS fraction FROM b WHERE bin IS NOT NULL GROUP BY bin""")
def raster_histogram(spark, sf_dir):
    return rounded(rs.raster_histogram(load(spark, sf_dir, "pixels")).select("bin", "fraction"))


# ---------------------------------------------------------------- sampling

def sample_inputs(spark, sf_dir):
    """Two rasters over the study area: the pixel table and its spectral bands."""
    pixels = load(spark, sf_dir, "pixels").unionByName(
        rz.bands_to_pixels(load(spark, sf_dir, "spectral"), "landsat_8", ["red", "nir"])
    )
    meta = bands(spark, "grid", "value").unionByName(bands(spark, "landsat_8", "red", "nir"))
    height = pixel_height(spark, sf_dir)
    grids = {
        "grid": GridSpec(-74.02, 40.89, 0.0018, 0.0015, 100, height),
        "landsat_8": GridSpec(-73.99, 40.86, 0.001, 0.0012, 100, height),
    }
    return pixels, meta, grids


def cell_of_sql(x0: float, y1: float, px: float, py: float) -> str:
    height = "(SELECT max(row) FROM pixels)"
    return (
        f"CAST(least({height}, greatest(0, floor(({num(y1)} - lat) / {num(py)}))) AS INT) AS r, "
        f"CAST(least(99, greatest(0, floor((lon - {num(x0)}) / {num(px)}))) AS INT) AS c"
    )


SAMPLE_SQL = with_inputs("points", "pixels", "spectral") + f""",
    in_grid AS (SELECT point_id, lon, lat, {cell_of_sql(-74.02, 40.89, 0.0018, 0.0015)} FROM points),
    in_sat AS (SELECT point_id, {cell_of_sql(-73.99, 40.86, 0.001, 0.0012)} FROM points)"""


def sample_sites(spark, sf_dir):
    """The points, and as many more as every 19th that lack a coordinate: NULL or NaN."""
    points = load(spark, sf_dir, "points")
    k = F.col("point_id") % 19
    lacking = points.where(k < 3).withColumns({
        "lon": F.when(k == 0, F.lit(None)).when(k == 1, F.lit(float("nan"))).otherwise(F.col("lon")),
        "lat": F.when(k == 2, F.lit(None)).otherwise(F.col("lat")),
        "point_id": -F.col("point_id") - 1,
    })
    return points.unionByName(lacking)


@query("nearest_pixel_join", SAMPLE_SQL + """
    SELECT g.point_id, 'value' AS feature, p.value FROM in_grid AS g JOIN pixels AS p ON p.row = g.r AND p.col = g.c
    UNION ALL SELECT s.point_id, 'red', t.red FROM in_sat AS s JOIN spectral AS t ON t.row = s.r AND t.col = s.c
    UNION ALL SELECT s.point_id, 'nir', t.nir FROM in_sat AS s JOIN spectral AS t ON t.row = s.r AND t.col = s.c""")
def nearest_pixel_join(spark, sf_dir):
    return sm.sample_long(sample_sites(spark, sf_dir), *sample_inputs(spark, sf_dir))


MATRIX_SQL = SAMPLE_SQL + """,
    m AS (SELECT g.point_id, round(g.lat, 6) AS lat, round(g.lon, 6) AS long, t.nir, t.red, p.value
      FROM in_grid AS g JOIN pixels AS p ON p.row = g.r AND p.col = g.c
      JOIN in_sat AS s USING (point_id) JOIN spectral AS t ON t.row = s.r AND t.col = s.c)"""


@query("sample_points", MATRIX_SQL + """ SELECT point_id, lat, long, nir, red, value FROM m
    UNION ALL SELECT -point_id - 1, CASE WHEN point_id % 19 < 2 THEN round(lat, 6) END,
        CASE point_id % 19 WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN round(lon, 6) END, NULL, NULL, NULL
    FROM points WHERE point_id % 19 < 3""")
def sample_points(spark, sf_dir):
    names = ["nir", "red", "value"]
    return rounded(sm.sample_points(sample_sites(spark, sf_dir), *sample_inputs(spark, sf_dir), names))


@query("feature_matrix_assemble", MATRIX_SQL + """ SELECT point_id, nir, red, value FROM m""")
def feature_matrix_assemble(spark, sf_dir):
    samples = sm.sample_long(sample_sites(spark, sf_dir), *sample_inputs(spark, sf_dir))
    return sm.assemble_matrix(samples, ["nir", "red", "value"])


# ---------------------------------------------------------------- feet, tiles in a window, wide medians, rasters side by side

def feet_grid(spark, sf_dir) -> GridSpec:
    """Source grid in EPSG:2263, whose lines lean against degrees by a third of a degree here."""
    return GridSpec(1_005_000.0, 262_000.0, 120.0, 100.0, 100, pixel_height(spark, sf_dir), 2263)


FEET_BOX = (-73.93, 40.70, -73.87, 40.885)
FEET_TARGET = (-73.955, 40.886, 0.0009, 0.0011, 120)
_FEET_X, _FEET_Y = plane_sql("lon", "lat")
FEET_SQL = f"""
    target AS (SELECT r.i AS row, c.i AS col, {num(FEET_TARGET[0])} + (c.i + 0.5) * {num(FEET_TARGET[2])} AS lon,
               {num(FEET_TARGET[1])} - (r.i + 0.5) * {num(FEET_TARGET[3])} AS lat
               FROM range(0, (SELECT max(row) + 1 FROM pixels)) AS r(i), range(0, {FEET_TARGET[4]}) AS c(i)),
    uv AS (SELECT row, col, lon, lat, ({_FEET_X} - 1005000) / 120 AS u, (262000 - {_FEET_Y}) / 100 AS v FROM target)"""


@query("raster_clip_reproject_feet", with_inputs("pixels") + f""", {FEET_SQL}
    SELECT CAST(uv.row AS INT) AS row, CAST(uv.col AS INT) AS col, value FROM uv JOIN pixels AS p
      ON p.row = CAST(floor(v) AS INT) AND p.col = CAST(floor(u) AS INT)
    WHERE lon BETWEEN {num(FEET_BOX[0])} AND {num(FEET_BOX[2])} AND lat BETWEEN {num(FEET_BOX[1])} AND {num(FEET_BOX[3])}""")
def raster_clip_reproject_feet(spark, sf_dir):
    """All target cells within the box, whose sides lean in feet: the clip loses none."""
    x0, y1, px, py, width = FEET_TARGET
    target = GridSpec(x0, y1, px, py, width, pixel_height(spark, sf_dir), 4326)
    moved = rs.clip_reproject(load(spark, sf_dir, "pixels"), feet_grid(spark, sf_dir), FEET_BOX, target)
    lon, lat = F.expr(target.centre_x("col")), F.expr(target.centre_y("row"))
    return moved.where(lon.between(FEET_BOX[0], FEET_BOX[2]) & lat.between(FEET_BOX[1], FEET_BOX[3])).select("row", "col", "value")


@query("raster_clip_tiles", with_inputs("pixels") + f"""
    SELECT row - min(row) OVER () AS row, col - min(col) OVER () AS col, value FROM (
      SELECT *, {num(-74.02)} + (col + 0.5) * {num(0.0018)} AS x, {num(40.89)} - (row + 0.5) * {num(0.0015)} AS y
      FROM pixels)
    WHERE x BETWEEN {num(CLIP_BOX[0])} AND {num(CLIP_BOX[2])} AND y BETWEEN {num(CLIP_BOX[1])} AND {num(CLIP_BOX[3])}""")
def raster_clip_tiles(spark, sf_dir):
    path = writers.write_raster(load(spark, sf_dir, "pixels"), fresh_path(spark, "tiles"), 16)
    clipped, _ = rs.clip_tiles(spark.read.parquet(path), 16, pixel_grid(spark, sf_dir), CLIP_BOX)
    return clipped.select("row", "col", "value")


query("focal_median_51x51", with_inputs("holes") + "," + neighbours_sql("holes", 25, "round(median(value), 9) AS median"))(
    focal_query("holes", 25, "median", False)
)


@query("raster_mosaic_side_by_side", with_inputs("holes") + """,
    parts AS (SELECT * FROM (VALUES (0, 0, 2), (0, 90, 1), (0, 300, 3)) AS v(dr, dc, o)),
    moved AS (SELECT row + dr AS row, col + dc AS col, value + o * 1000 AS value, o FROM holes, parts),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY o) AS k FROM moved)
    SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, round(value, 6) AS value FROM ranked WHERE k = 1""")
def raster_mosaic_side_by_side(spark, sf_dir):
    """Two rasters that share ten columns and one beside them: only the shared columns are shuffled."""
    parts = {"b": (0, 2), "a": (90, 1), "c": (300, 3)}
    lifted = F.array(*[F.struct(F.lit(n).alias("raster_id"), F.lit(float(o * 1000)).alias("lift")) for n, (_, o) in parts.items()])
    pixels = load(spark, sf_dir, "holes").drop("raster_id").select("*", F.inline(lifted)).withColumn("value", F.col("value") + F.col("lift"))
    height = pixel_height(spark, sf_dir)
    meta = small_table(
        spark, [(n, -74.0 + c * 0.25, 40.0, 0.25, 0.5, 100, height, o) for n, (c, o) in parts.items()],
        "raster_id string, x0 double, y1 double, px double, py double, width int, height int, file_order int",
    )
    return rounded(rs.mosaic(pixels.drop("lift"), meta).select("row", "col", "value"))


@query("warp_tiles_bilinear", QUERIES["reproject_bilinear"].sql)
def warp_tiles_bilinear(spark, sf_dir):
    path = writers.write_raster(load(spark, sf_dir, "pixels"), fresh_path(spark, "tiles"), 16)
    moved = wp.warp_tiles(spark.read.parquet(path), 16, mercator_grid(spark, sf_dir), degree_grid(spark, sf_dir), "bilinear", 16)
    return rounded(moved.select("row", "col", "value"), 4)
