"""Checked queries: GeoJSON, geometry, study-area filters, cell covers and rasterised layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraquilt.functions import crs, geometry as geo, planar
from terraquilt.grid import grid_spec_columns
from terraquilt.operators import cover as cv, features as ft, rasterize as rz
from terraquilt.plans.fixtures import (
    BBOX, buildings, cells_sql, donuts, grid, load, num, rectangles, streets, table, triangles, with_inputs, zones,
)
from terraquilt.plans.registry import query, rounded
from terraquilt.plans.series_queries import BUILDING_FILTER_SQL, STREET_FILTER_SQL, plane_sql
from terraquilt.session import fresh_path
from terraquilt.sources import readers, writers
from terraquilt.streaming import cell_states as cs

X0, Y0, X1, Y1 = (num(v) for v in BBOX)
G = grid(500)
FINE = grid(100)
CELLS = f"cells AS ({cells_sql(G)})"
HIT = "b.xmin <= cx1 AND b.xmax >= cx0 AND b.ymin <= cy1 AND b.ymax >= cy0"


def ring_area_sql(vertices: str) -> str:
    """Shoelace area per (id, part) of ``v(id, part, k, lon, lat)`` in square feet, as further CTEs."""
    px, py = plane_sql("lon", "lat")
    return f"""{vertices},
    projected AS (SELECT id, part, k, {px} AS x, {py} AS y FROM v),
    based AS (SELECT id, part, k, x - first(x) OVER w AS x, y - first(y) OVER w AS y
              FROM projected WINDOW w AS (PARTITION BY id, part ORDER BY k)),
    steps AS (SELECT id, part, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny
              FROM based WINDOW w AS (PARTITION BY id, part ORDER BY k)),
    areas AS (SELECT id, part, abs(sum(x * ny - nx * y)) / 2 AS area FROM steps WHERE nx IS NOT NULL
              GROUP BY id, part)"""


def rect_vertices_sql(source: str, part: str = "0") -> str:
    return f"""v AS (SELECT id, {part} AS part, k,
        CASE k WHEN 1 THEN xmax WHEN 2 THEN xmax ELSE xmin END AS lon,
        CASE k WHEN 2 THEN ymax WHEN 3 THEN ymax ELSE ymin END AS lat
        FROM {source}, range(0, 5) AS ks(k))"""


# ---------------------------------------------------------------- sources and sinks

@query("json_records_scan", with_inputs("buildings") + """
    SELECT id, bin, cnstrct_yr, heightroof, xmin, ymax FROM buildings""")
def json_records_scan(spark, sf_dir):
    path = fresh_path(spark, "records")
    records = load(spark, sf_dir, "buildings").select("id", "bin", "cnstrct_yr", "heightroof", "xmin", "ymax")
    records.write.json(path)
    return readers.read_records(spark, path, records.schema, multiline=False)


@query("geojson_features", with_inputs("zones") + """
    SELECT id AS OBJECTID, ZONEDIST, size, round(xmin, 9) AS west, round(ymax, 9) AS north, 5 AS n_vertices FROM zones""")
def geojson_features(spark, sf_dir):
    shapes = zones(spark, sf_dir).select(F.col("id").alias("OBJECTID"), "ZONEDIST", "size", "geometry")
    path = writers.write_features(shapes, fresh_path(spark, "zones"))
    features = readers.read_features(spark, path, "OBJECTID BIGINT, ZONEDIST STRING, size INT", multiline=False)
    return ft.with_envelope(features).select(
        "OBJECTID", "ZONEDIST", "size", F.round("xmin", 9).alias("west"), F.round("ymax", 9).alias("north"),
        F.expr(f"size({geo.vertices('geometry.parts')})").alias("n_vertices"),
    )


@query("geojson_sink", """
    SELECT p_partkey AS id, '{"type":"Feature","properties":{"id":' || p_partkey || ',"brand":"' || p_brand
        || '"},"geometry":{"type":"Point","coordinates":[' || p_size || '.0,' || (p_partkey % 90) || '.0]}}' AS value
    FROM part""")
def geojson_sink(spark, sf_dir):
    place = F.expr(geo.point_geometry("p_size", "p_partkey % 90"))
    shapes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), place.alias("geometry")
    )
    path = writers.write_features(shapes, fresh_path(spark, "features"))
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.properties.id").cast("bigint").alias("id"), "value")


# ---------------------------------------------------------------- geometry

@query("wkt_bbox_polygon", with_inputs("zones") + """
    SELECT id, xmin AS a, ymin AS b, xmax AS c, ymax AS d, 5 AS n FROM zones""")
def wkt_bbox_polygon(spark, sf_dir):
    shell = F.col("geometry.parts")[0][0]
    return zones(spark, sf_dir).select(
        "id", shell[0]["x"].alias("a"), shell[0]["y"].alias("b"), shell[2]["x"].alias("c"), shell[2]["y"].alias("d"),
        F.size(shell).alias("n"),
    )


@query("geometry_from_geojson", with_inputs("zones") + """
    SELECT id, 'Polygon' AS type, xmin, ymin, xmax, ymax FROM zones""")
def geometry_from_geojson(spark, sf_dir):
    text = zones(spark, sf_dir).select("id", F.expr(geo.geometry_to_geojson("geometry")).alias("j"))
    parsed = text.withColumn("s", F.from_json("j", "type STRING, coordinates STRING")).select(
        "id", F.expr(geo.geometry_from_geojson("s")).alias("g")
    )
    return ft.with_envelope(parsed, "g").select("id", "g.type", *ft.ENVELOPE)


@query("envelope", with_inputs("streets") + """
    SELECT id, least(xfrom, xto) AS xmin, least(yfrom, yto) AS ymin,
           greatest(xfrom, xto) AS xmax, greatest(yfrom, yto) AS ymax FROM streets""")
def envelope(spark, sf_dir):
    lines = streets(spark, sf_dir).select(F.col("OBJECTID").alias("id"), "geometry")
    return ft.with_envelope(lines).drop("geometry")


@query("polygon_area", with_inputs("zones") + ",\n" + ring_area_sql(f"""
    inner_box AS (SELECT id, xmin + side / 4 AS xmin, ymin + side / 4 AS ymin, xmax - side / 4 AS xmax,
                         ymax - side / 4 AS ymax FROM zones),
    both_parts AS (SELECT id, 0 AS part, xmin, ymin, xmax, ymax FROM zones
                   UNION ALL SELECT id, 1, xmin, ymin, xmax, ymax FROM inner_box),
    {rect_vertices_sql("both_parts", "part")}""") + """
    SELECT id, round(sum(CASE part WHEN 0 THEN area ELSE -area END), 0) AS shape_area FROM areas GROUP BY id""")
def polygon_area(spark, sf_dir):
    d = donuts(spark, sf_dir)
    return d.select("id", F.round(ft.polygon_area_sqft(), 0).alias("shape_area"))


@query("area_threshold", with_inputs("buildings") + ",\n" + ring_area_sql(rect_vertices_sql("buildings")) + """
    SELECT id, round(area, 2) AS shape_area FROM areas WHERE area >= 400""")
def area_threshold(spark, sf_dir):
    b = buildings(spark, sf_dir).select("id", "geometry")
    measured = b.withColumn("shape_area", ft.polygon_area_sqft())
    return rounded(ft.area_threshold(measured, 400).select("id", "shape_area"), 2)


_AX, _AY = plane_sql("xfrom", "yfrom")
_BX, _BY = plane_sql("xto", "yto")


@query("line_length", with_inputs("streets") + f""",
    ends AS (SELECT id, {_AX} AS ax, {_AY} AS ay, {_BX} AS bx, {_BY} AS b_y FROM streets)
    SELECT id AS OBJECTID, round(sqrt(pow(bx - ax, 2) + pow(b_y - ay, 2)), 4) AS length_ft,
           round(sqrt(pow(bx - ax, 2) + pow(b_y - ay, 2)) * 1200 / 3937, 4) AS length_m FROM ends""")
def line_length(spark, sf_dir):
    s = streets(spark, sf_dir).select("OBJECTID", "geometry")
    return rounded(ft.with_line_length(s).drop("geometry"), 4)


def _box_corners(x0: str, y0: str, x1: str, y1: str, clockwise: bool) -> list[tuple[str, str]]:
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return ring[::-1] if clockwise else ring


_RINGS = {
    "shell": _box_corners("xmin", "ymin", "xmax", "ymax", False),
    "hole": _box_corners("xmin + side / 4", "ymin + side / 4", "xmax - side / 4", "ymax - side / 4", True),
}


@query("orient_ring", with_inputs("zones") + " SELECT id, " + ", ".join(
    f"round({v}, 9) AS {ring}_{axis}{i}" for ring, corners in _RINGS.items() for i, c in enumerate(corners) for axis, v in zip("xy", c)
) + " FROM zones")
def orient_ring(spark, sf_dir):
    d = donuts(spark, sf_dir)
    # the hole of the input is counter-clockwise, and every second shell is turned round first
    mixed = "array(transform(geometry.parts[0], (m_, n_) -> IF(n_ = 0 AND id % 2 = 0, reverse(m_), m_)))"
    rings = d.select("id", F.expr(f"{geo.orient_parts(mixed)}[0]").alias("rings"))
    return rings.select("id", *[
        F.expr(f"round(rings[{r}][{i}].{axis}, 9)").alias(f"{ring}_{axis}{i}")
        for r, ring in enumerate(_RINGS) for i in range(5) for axis in "xy"
    ])


@query("grid_spec", with_inputs("points") + """,
    b AS (SELECT point_id % 5 AS part, min(lon) AS x0, min(lat) AS y0, max(lon) AS x1, max(lat) AS y1
          FROM points GROUP BY 1),
    s AS (SELECT part, r.res, x1 - x0 AS dx, y1 - y0 AS dy,
                 CAST(round_even((x1 - x0) / (r.res / 111320.0::DOUBLE), 0) AS INT) + 1 AS width,
                 CAST(round_even((y1 - y0) / (r.res / 111320.0::DOUBLE), 0) AS INT) + 1 AS height
          FROM b, (VALUES (30), (100), (500), (1000)) AS r(res))
    SELECT part, res, width, height, round(dx / width, 9) AS px, round(dy / height, 9) AS py FROM s""")
def grid_spec(spark, sf_dir):
    boxes = load(spark, sf_dir, "points").groupBy((F.col("point_id") % 5).alias("part")).agg(
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1")
    )
    sized = boxes.withColumn("res", F.explode(F.array(*[F.lit(r) for r in (30, 100, 500, 1000)])))
    spec = grid_spec_columns(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.col("res"))
    return rounded(sized.select("part", "res", *[c.alias(n) for n, c in spec.items()]), 9)


# ---------------------------------------------------------------- study-area filters

INSIDE = f"xmin >= {X0} AND xmax <= {X1} AND ymin >= {Y0} AND ymax <= {Y1}"
MEETS = f"xmin <= {X1} AND xmax >= {X0} AND ymin <= {Y1} AND ymax >= {Y0}"


@query("bbox_contains_semi", with_inputs("buildings") + f" SELECT id, bin FROM buildings WHERE {INSIDE}")
def bbox_contains_semi(spark, sf_dir):
    return ft.bbox_contains(buildings(spark, sf_dir), BBOX).select("id", "bin")


@query("polygon_contains", with_inputs("zones") + f" SELECT id FROM zones WHERE {INSIDE}")
def polygon_contains(spark, sf_dir):
    # the envelope is stored with the shape, so the filter reaches the Parquet scan
    path = writers.write_parquet(ft.with_envelope(zones(spark, sf_dir).select("id", "geometry")), fresh_path(spark, "zones"))
    return ft.bbox_contains(spark.read.parquet(path), BBOX).select("id")


@query("bbox_intersects_semi", with_inputs("buildings") + f" SELECT id, bin FROM buildings WHERE {MEETS}")
def bbox_intersects_semi(spark, sf_dir):
    return ft.bbox_intersects(buildings(spark, sf_dir), BBOX).select("id", "bin")


@query("bbox_midpoint_semi", with_inputs("zones") + f"""
    SELECT id, ZONEDIST FROM zones WHERE (xmin + xmax) / 2 > {X0} AND (xmin + xmax) / 2 < {X1}
      AND (ymin + ymax) / 2 > {Y0} AND (ymin + ymax) / 2 < {Y1}""")
def bbox_midpoint_semi(spark, sf_dir):
    return ft.bbox_midpoint(zones(spark, sf_dir), BBOX).select("id", "ZONEDIST")


@query("filter_buildings", with_inputs("buildings") + ",\n" + ring_area_sql(rect_vertices_sql("buildings")) + f"""
    SELECT b.id, CAST(bin AS INT) AS bin, CAST(cnstrct_yr AS INT) AS cnstrct_yr, round(area, 2) AS shape_area
    FROM buildings AS b JOIN areas USING (id)
    WHERE cnstrct_yr IS NOT NULL AND {BUILDING_FILTER_SQL} AND {MEETS} AND area >= 400""")
def filter_buildings(spark, sf_dir):
    raw = rectangles(load(spark, sf_dir, "buildings"), "the_geom")
    return rounded(ft.filter_buildings(raw).select("id", "bin", "cnstrct_yr", "shape_area"), 2)


@query("filter_streets", with_inputs("streets") + f""",
    ends AS (SELECT *, {_AX} AS ax, {_AY} AS ay, {_BX} AS bx, {_BY} AS b_y FROM streets WHERE {STREET_FILTER_SQL})
    SELECT id AS OBJECTID, trim(RW_TYPE) AS RW_TYPE, StreetWidth_Min,
           round(sqrt(pow(bx - ax, 2) + pow(b_y - ay, 2)), 4) AS length_ft
    FROM ends WHERE least(xfrom, xto) >= {X0} AND greatest(xfrom, xto) <= {X1}
      AND least(yfrom, yto) >= {Y0} AND greatest(yfrom, yto) <= {Y1}""")
def filter_streets(spark, sf_dir):
    kept = ft.filter_streets(streets(spark, sf_dir), predicate="contains")
    return rounded(kept.select("OBJECTID", "RW_TYPE", "StreetWidth_Min", "length_ft"), 4)


@query("street_features", with_inputs("streets") + """,
    a AS (SELECT *, degrees(atan2(feet_dy, feet_dx)) AS d FROM streets)
    SELECT id AS OBJECTID, CAST(trim(RW_TYPE) AS INT) AS RW_TYPE, NULLIF(trim(BIKE_TRAFDIR), '') AS BIKE_TRAFDIR,
           CAST(NULLIF(trim(Number_Total_Lanes), '') AS DOUBLE) AS Number_Total_Lanes,
           (StreetWidth_Min + StreetWidth_Max) / 2.0::DOUBLE AS street_width_avg
    FROM a""")
def street_features(spark, sf_dir):
    return ft.street_features(streets(spark, sf_dir)).select(
        "OBJECTID", "RW_TYPE", "BIKE_TRAFDIR", "Number_Total_Lanes", "street_width_avg"
    )


# ---------------------------------------------------------------- covers

@query("cell_cover_join", with_inputs("buildings") + f""", {CELLS}
    SELECT b.id, row, col FROM buildings AS b JOIN cells ON {HIT}""")
def cell_cover_join(spark, sf_dir):
    return cv.cover_cells(buildings(spark, sf_dir).select("id", "geometry"), G).select("id", "row", "col")


TRIANGLE_HIT = f"{HIT} AND (greatest(cx0, b.xmin) - b.xmin) + (greatest(cy0, b.ymin) - b.ymin) <= b.side"


@query("box_intersects", with_inputs("zones") + f""", fine AS ({cells_sql(FINE)})
    SELECT b.id, row, col FROM zones AS b JOIN fine ON {TRIANGLE_HIT}""")
def box_intersects(spark, sf_dir):
    return cv.cover_cells(triangles(spark, sf_dir), FINE, block=4).select("id", "row", "col")


LINE_HIT = """least(xfrom, xto) <= cx1 AND greatest(xfrom, xto) >= cx0
    AND least(yfrom, yto) <= cy1 AND greatest(yfrom, yto) >= cy0
    AND least(s00, s01, s10, s11) <= 0 AND greatest(s00, s01, s10, s11) >= 0"""
LINE_SIDES = """(xto - xfrom) * (cy0 - yfrom) - (yto - yfrom) * (cx0 - xfrom) AS s00,
    (xto - xfrom) * (cy1 - yfrom) - (yto - yfrom) * (cx0 - xfrom) AS s01,
    (xto - xfrom) * (cy0 - yfrom) - (yto - yfrom) * (cx1 - xfrom) AS s10,
    (xto - xfrom) * (cy1 - yfrom) - (yto - yfrom) * (cx1 - xfrom) AS s11"""
LINE_COVER = f"""line_cover AS (SELECT * FROM (SELECT s.*, row, col, cx0, cx1, cy0, cy1, {LINE_SIDES}
    FROM streets AS s JOIN cells ON least(xfrom, xto) <= cx1 AND greatest(xfrom, xto) >= cx0
      AND least(yfrom, yto) <= cy1 AND greatest(yfrom, yto) >= cy0) WHERE {LINE_HIT})"""


@query("line_cover_join", with_inputs("streets") + f""", {CELLS}, {LINE_COVER}
    SELECT id AS OBJECTID, row, col FROM line_cover""")
def line_cover_join(spark, sf_dir):
    return cv.cover_cells(streets(spark, sf_dir).select("OBJECTID", "geometry"), G).select("OBJECTID", "row", "col")


AOI = """aoi AS (SELECT CAST(c_custkey AS INT) AS tile, lon - w AS ax0, lat - w AS ay0, lon + w AS ax1, lat + w AS ay1
    FROM (SELECT point_id AS c_custkey, lon, lat, CAST(100 + point_id % 300 AS DOUBLE) / 100000.0::DOUBLE AS w
          FROM points) AS p)"""


def aoi_boxes(spark, sf_dir):
    p = load(spark, sf_dir, "points")
    wide = p.withColumn("w", F.expr("CAST(100 + point_id % 300 AS DOUBLE) / 100000.0D"))
    box = F.expr(geo.box_polygon("lon - w", "lat - w", "lon + w", "lat + w"))
    return wide.select(F.col("point_id").cast("int").alias("tile"), box.alias("aoi"))


@query("tile_aoi_join", with_inputs("buildings", "points") + f""", {AOI}
    SELECT b.id, tile FROM buildings AS b JOIN aoi
      ON b.xmin <= ax1 AND b.xmax >= ax0 AND b.ymin <= ay1 AND b.ymax >= ay0""")
def tile_aoi_join(spark, sf_dir):
    shapes = buildings(spark, sf_dir).select("id", "geometry")
    return cv.aoi_join(shapes, aoi_boxes(spark, sf_dir), columns=["id", "tile"]).select("id", "tile")


OVERLAY_CTE = f"""{AOI},
    pieces AS (SELECT b.id * 100000 + tile AS id, b.id AS building, tile, greatest(b.xmin, ax0) AS xmin,
        greatest(b.ymin, ay0) AS ymin, least(b.xmax, ax1) AS xmax, least(b.ymax, ay1) AS ymax
        FROM buildings AS b JOIN aoi ON b.xmin < ax1 AND b.xmax > ax0 AND b.ymin < ay1 AND b.ymax > ay0)"""


@query("overlay_intersection", with_inputs("buildings", "points") + f""", {OVERLAY_CTE},
    {ring_area_sql(rect_vertices_sql("pieces"))}
    SELECT building AS id, tile, round(area, 2) AS area FROM pieces JOIN areas USING (id)""")
def overlay_intersection(spark, sf_dir):
    area = cv.Measure(
        lambda parts: f"round({geo.parts_area(geo.transform_parts(parts, crs.vertices_to_state_plane))}, 2)",
        lambda rings: planar.round_half_up(planar.state_plane_areas(rings), 2),
    )
    shapes = buildings(spark, sf_dir).select("id", "geometry")
    cut = cv.overlay_intersection(shapes, aoi_boxes(spark, sf_dir), measures={"area": area}, columns=["id", "tile"])
    return cut.select("id", "tile", "area")


# ---------------------------------------------------------------- statistics per cell

COVER = f"""{CELLS},
    hits AS (SELECT b.*, row, col, cx0, cx1, cy0, cy1 FROM zones AS b JOIN cells ON {HIT})"""


def zone_cover(spark, sf_dir):
    return cv.cover_cells(zones(spark, sf_dir).select("id", "size", "ZONEDIST", "geometry"), G)


def grid_left(aggregates: str, coalesced: str) -> str:
    return with_inputs("zones") + f""", {COVER},
    agg AS (SELECT row, col, {aggregates} FROM hits GROUP BY row, col)
    SELECT row, col, {coalesced} FROM cells LEFT JOIN agg USING (row, col)"""


@query("cell_mean", grid_left("avg(size) AS v", "round(coalesce(v, 0), 9) AS mean_size"))
def cell_mean(spark, sf_dir):
    return rounded(cv.cell_statistics(zone_cover(spark, sf_dir), {"mean_size": ("mean", F.col("size"))}, G), 9)


@query("cell_std", grid_left("stddev_pop(size) AS v", "round(coalesce(v, -1), 9) AS std_size"))
def cell_std(spark, sf_dir):
    return rounded(cv.cell_statistics(zone_cover(spark, sf_dir), {"std_size": ("std_dev", F.col("size"))}, G), 9)


@query("cell_mode", with_inputs("zones") + f""", {COVER},
    counted AS (SELECT row, col, size, count(*) AS n FROM hits GROUP BY row, col, size),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY n DESC, size) AS k FROM counted)
    SELECT row, col, coalesce(size, -1) AS mode_size
    FROM cells LEFT JOIN (SELECT * FROM ranked WHERE k = 1) USING (row, col)""")
def cell_mode(spark, sf_dir):
    return cv.cell_mode(zone_cover(spark, sf_dir), F.col("size"), G, "mode_size")


@query("cell_count", grid_left("count(*) AS n", "coalesce(n, 0) AS n_zones"))
def cell_count(spark, sf_dir):
    return cv.cell_statistics(zone_cover(spark, sf_dir), {"n_zones": ("count", F.col("id"))}, G)


@query("cell_presence", grid_left(
    "least(count(*) FILTER (ZONEDIST = 'PARK'), 1) AS p", "coalesce(p, 0) AS any_park"))
def cell_presence(spark, sf_dir):
    park = F.when(F.col("ZONEDIST") == "PARK", 1)
    return cv.cell_statistics(zone_cover(spark, sf_dir), {"any_park": ("presence", park)}, G)


@query("cell_category_counts", grid_left(
    "count(*) FILTER (ZONEDIST[1:1] = 'R') AS r, count(*) FILTER (ZONEDIST[1:1] = 'M') AS m, "
    "count(*) FILTER (ZONEDIST[1:1] = 'C') AS c, count(*) FILTER (ZONEDIST[1:1] = 'P') AS p",
    "coalesce(r, 0) AS has_residence, coalesce(m, 0) AS has_manufacture, coalesce(c, 0) AS has_commercial, "
    "coalesce(p, 0) AS has_park"))
def cell_category_counts(spark, sf_dir):
    letter = F.substring("ZONEDIST", 1, 1)
    return cv.cell_category_counts(zone_cover(spark, sf_dir), letter, rz.ZONE_COUNT_BANDS, G)


CLIPPED = f"""
    clipped AS (SELECT id * 10000 + row * 100 + col AS id, row, col, greatest(xmin, cx0) AS xmin,
        greatest(ymin, cy0) AS ymin, least(xmax, cx1) AS xmax, least(ymax, cy1) AS ymax FROM hits),
    {ring_area_sql(rect_vertices_sql("clipped"))}"""


@query("cell_sum_area", with_inputs("zones") + f""", {COVER}, {CLIPPED},
    agg AS (SELECT row, col, sum(area) AS v FROM clipped JOIN areas USING (id) GROUP BY row, col)
    SELECT row, col, round(coalesce(v, 0), 0) AS area FROM cells LEFT JOIN agg USING (row, col)""")
def cell_sum_area(spark, sf_dir):
    cover = zone_cover(spark, sf_dir)
    return rounded(cv.cell_statistics(cover, {"area": ("sum_area", cv.clip_area_sqft(G))}, G), 0)


@query("box_clip_area", with_inputs("zones") + f""", {COVER}, {CLIPPED}
    SELECT id // 10000 AS id, row, col, round(area, 1) AS area FROM clipped JOIN areas USING (id)""")
def box_clip_area(spark, sf_dir):
    return zone_cover(spark, sf_dir).select("id", "row", "col", F.round(cv.clip_area_sqft(G), 1).alias("area"))


@query("cell_entropy", with_inputs("zones") + f""", {COVER},
    bins AS (SELECT row, col, floor((id * 7 % 190) / 3.0) AS bin, count(*) AS n FROM hits
             WHERE id * 7 % 190 < 180 GROUP BY ALL),
    p AS (SELECT row, col, n / sum(n) OVER (PARTITION BY row, col) AS p FROM bins),
    agg AS (SELECT row, col, -sum(p * ln(p)) AS e FROM p GROUP BY row, col)
    SELECT row, col, round(e, 6) + 0.0 AS entropy FROM cells LEFT JOIN agg USING (row, col)""")
def cell_entropy(spark, sf_dir):
    value = (F.col("id") * 7 % 190).cast("double")
    return rounded(cv.cell_entropy(zone_cover(spark, sf_dir), value, G))


_BINS = ", ".join(f"count(*) FILTER (size >= {i} AND size < {i + 3})" for i in range(0, 180, 3))


@query("cell_stat_dispatch", grid_left(
    "avg(size) AS m, stddev_pop(size) AS s, count(*) AS n, least(count(*), 1) AS p, sum(CAST(size AS DOUBLE)) AS a, "
    "list_sort(list(size)) AS sizes, "
    f"list_filter([{_BINS}], lambda x: x > 0) AS bins",
    "round(coalesce(m, 0), 9) AS mean_size, round(coalesce(s, -1), 9) AS std_size, coalesce(n, 0) AS n_zones, "
    "coalesce(p, 0) AS any_zone, round(coalesce(a, 0), 9) AS sum_size, "
    # the least of the sizes that occur most often
    "coalesce(list_min(list_filter(sizes, lambda x: len(list_filter(sizes, lambda y: y = x)) = "
    "list_max(list_transform(sizes, lambda z: len(list_filter(sizes, lambda y: y = z)))))), -1) AS mode_size, "
    "round(CASE WHEN n > 0 THEN -list_sum(list_transform(bins, lambda x: x / list_sum(bins) * ln(x / list_sum(bins)))) END, 6) + 0.0"
    " AS entropy_size"))
def cell_stat_dispatch(spark, sf_dir):
    size = F.col("size")
    requests = {
        "mean_size": ("mean", size), "std_size": ("std_dev", size), "n_zones": ("count", size), "any_zone": ("presence", size),
        "sum_size": ("sum_area", size.cast("double")), "mode_size": ("mode", size), "entropy_size": ("entropy", size),
    }
    stats = rounded(cv.cell_statistics(zone_cover(spark, sf_dir), requests, G), 9)
    return stats.withColumn("entropy_size", F.round("entropy_size", 6) + F.lit(0.0))


# ---------------------------------------------------------------- rasterised layers

def mode_sql(column: str, source: str = "hits") -> str:
    return f"""(SELECT row, col, {column} FROM (SELECT row, col, {column}, row_number() OVER
        (PARTITION BY row, col ORDER BY count(*) DESC, {column}) AS k FROM {source} WHERE {column} IS NOT NULL
        GROUP BY row, col, {column}) WHERE k = 1)"""


@query("rasterize_buildings", with_inputs("buildings") + f""", {CELLS},
    hits AS (SELECT b.*, row, col, cx0, cx1, cy0, cy1 FROM buildings AS b JOIN cells ON {HIT}), {CLIPPED},
    agg AS (SELECT row, col, avg(CAST(heightroof AS DOUBLE)) AS h, stddev_pop(CAST(heightroof AS DOUBLE)) AS s,
                   avg(CAST(cnstrct_yr AS INT)) AS y FROM hits GROUP BY row, col),
    built AS (SELECT row, col, sum(area) AS a FROM clipped JOIN areas USING (id) GROUP BY row, col)
    SELECT row, col, round(coalesce(h, 0), 9) AS building_height, round(coalesce(s, -1), 9) AS building_height_std,
           round(coalesce(y, 0), 9) AS building_year, round(coalesce(a, 0), 1) AS building_area
    FROM cells LEFT JOIN agg USING (row, col) LEFT JOIN built USING (row, col)""")
def rasterize_buildings(spark, sf_dir):
    typed = ft.cast_columns(buildings(spark, sf_dir), ft.BUILDING_TYPES)
    digits = {"building_height": 9, "building_height_std": 9, "building_year": 9, "building_area": 1}
    bands = rz.rasterize_buildings(typed, G)
    return bands.select("row", "col", *[F.round(c, d).alias(c) for c, d in digits.items()])


STREET_LAYER_SQL = with_inputs("streets") + f""", {CELLS}, {LINE_COVER},
    s AS (SELECT id, CAST(trim(RW_TYPE) AS INT) AS rw, (StreetWidth_Min + StreetWidth_Max) / 2.0::DOUBLE AS w,
             CAST(NULLIF(trim(Number_Total_Lanes), '') AS DOUBLE) AS l,
             dense_rank() OVER (ORDER BY TrafDir) - 1 AS t, dense_rank() OVER (ORDER BY SegmentTyp) - 1 AS o
          FROM streets),
    f AS (SELECT id, rw, t, o, coalesce(w, median(w) OVER (PARTITION BY rw)) AS w,
                 coalesce(l, median(l) OVER (PARTITION BY rw)) AS l FROM s),
    hits AS (SELECT row, col, f.* FROM line_cover JOIN f USING (id)),
    agg AS (SELECT row, col, avg(w) AS w, avg(l) AS l, least(count(*) FILTER (rw = 2), 1) AS hw
            FROM hits GROUP BY row, col)
    SELECT row, col, round(coalesce(agg.w, 0), 9) AS street_width, CAST(coalesce(t.t, -1) AS INT) AS street_traffic,
           round(coalesce(agg.l, 0), 9) AS street_lanes, CAST(coalesce(o.o, -1) AS INT) AS street_orientation,
           coalesce(rw.rw, -1) AS street_type, coalesce(hw, 0) AS high_way
    FROM cells LEFT JOIN agg USING (row, col) LEFT JOIN {mode_sql("t")} AS t USING (row, col)
    LEFT JOIN {mode_sql("o")} AS o USING (row, col) LEFT JOIN {mode_sql("rw")} AS rw USING (row, col)"""


@query("rasterize_streets", STREET_LAYER_SQL)
def rasterize_streets(spark, sf_dir):
    derived = ft.street_features(streets(spark, sf_dir)).withColumn("direction", F.col("SegmentTyp"))
    return rounded(rz.rasterize_streets(derived, G), 9)


ZONE_LEVELS = """ranked AS (SELECT *, CAST(dense_rank() OVER (ORDER BY {a}) - 1 AS INT) AS a,
    CAST(dense_rank() OVER (ORDER BY {b}) - 1 AS INT) AS b FROM zones)"""


def two_modes_sql(a: str, b: str, name_a: str, name_b: str) -> str:
    return with_inputs("zones") + f""", {CELLS}, {ZONE_LEVELS.format(a=a, b=b)},
    hits AS (SELECT row, col, b.a, b.b FROM ranked AS b JOIN cells ON {HIT})
    SELECT row, col, coalesce(a.a, -1) AS {name_a}, coalesce(b.b, -1) AS {name_b}
    FROM cells LEFT JOIN {mode_sql("a")} AS a USING (row, col) LEFT JOIN {mode_sql("b")} AS b USING (row, col)"""


@query("rasterize_overlays", two_modes_sql("OVERLAY", "split_part(OVERLAY, '-', 1)", "overlay_level2", "overlay_level1"))
def rasterize_overlays(spark, sf_dir):
    return rz.rasterize_overlays(ft.overlay_levels(zones(spark, sf_dir)), G)


@query("rasterize_special", two_modes_sql("split_part(SDLBL, '-', 1)", "SDLBL", "sd_level1", "sd_level2"))
def rasterize_special(spark, sf_dir):
    return rz.rasterize_special(ft.special_district_levels(zones(spark, sf_dir)), G)


@query("rasterize_zoning", with_inputs("zones") + f""", {CELLS},
    ranked AS (SELECT *, CAST(dense_rank() OVER (ORDER BY ZONEDIST) - 1 AS INT) AS l3,
        CAST(dense_rank() OVER (ORDER BY split_part(ZONEDIST, '-', 1)) - 1 AS INT) AS l2,
        CAST(dense_rank() OVER (ORDER BY ZONEDIST[1:1]) - 1 AS INT) AS l1 FROM zones),
    hits AS (SELECT row, col, b.l1, b.l2, b.l3, b.ZONEDIST FROM ranked AS b JOIN cells ON {HIT}),
    agg AS (SELECT row, col, count(*) FILTER (ZONEDIST LIKE 'R%') AS r, count(*) FILTER (ZONEDIST LIKE 'M%') AS m,
            count(*) FILTER (ZONEDIST LIKE 'C%') AS c, count(*) FILTER (ZONEDIST LIKE 'P%') AS p
            FROM hits GROUP BY row, col)
    SELECT row, col, coalesce(l1.l1, -1) AS zonedist_level1, coalesce(l2.l2, -1) AS zonedist_level2,
           coalesce(l3.l3, -1) AS zonedist_level3, coalesce(r, 0) AS has_residence, coalesce(m, 0) AS has_manufacture,
           coalesce(c, 0) AS has_commercial, coalesce(p, 0) AS has_park
    FROM cells LEFT JOIN agg USING (row, col) LEFT JOIN {mode_sql("l1")} AS l1 USING (row, col)
    LEFT JOIN {mode_sql("l2")} AS l2 USING (row, col) LEFT JOIN {mode_sql("l3")} AS l3 USING (row, col)""")
def rasterize_zoning(spark, sf_dir):
    return rz.rasterize_zoning(ft.zoning_levels(zones(spark, sf_dir)), G)


# ---------------------------------------------------------------- large files, shapes of all sizes, convex tiles

def one_array(rows, path: str, head: str = "[", tail: str = "]") -> str:
    """Write texts (column ``value``) as elements of one JSON array a file, over several lines."""
    placed = rows.repartition(3).withColumn("at", F.monotonically_increasing_id())
    ends = placed.groupBy(F.shiftright("at", 33).alias("file")).agg(F.min("at").alias("low"), F.max("at").alias("high"))
    lines = placed.withColumn("file", F.shiftright("at", 33)).join(F.broadcast(ends), "file").select(F.concat(  # a row a file
        F.when(F.col("at") == F.col("low"), head).otherwise(",\n  "), "value", F.when(F.col("at") == F.col("high"), tail).otherwise("")
    ))
    lines.write.text(path)
    return path


@query("json_records_split_scan", with_inputs("buildings") + """
    SELECT id, bin, cnstrct_yr, 'a "}" ] \\' || base_bbl || ' [ {' AS note, xmin FROM buildings""")
def json_records_split_scan(spark, sf_dir):
    records = load(spark, sf_dir, "buildings").select(
        "id", "bin", "cnstrct_yr", F.concat(F.lit('a "}" ] \\'), "base_bbl", F.lit(" [ {")).alias("note"), "xmin"
    )
    path = one_array(records.select(F.to_json(F.struct("*")).alias("value")), fresh_path(spark, "records"))
    return readers.read_records(spark, path, records.schema, split=True)


@query("geojson_split_features", with_inputs("zones") + """
    SELECT id AS OBJECTID, ZONEDIST, size, round(xmin, 9) AS west, round(ymax, 9) AS north, 5 AS n_vertices FROM zones""")
def geojson_split_features(spark, sf_dir):
    shapes = zones(spark, sf_dir).select(F.col("id").alias("OBJECTID"), "ZONEDIST", "size", "geometry")
    head = '{"type": "FeatureCollection", "crs": {"properties": {"features": [{"name": "}"}]}},\n "features": [\n'
    path = one_array(writers.to_feature_lines(shapes), fresh_path(spark, "zones"), head, '], "more": [{"type": "Feature"}]}')
    features = readers.read_features(spark, path, "OBJECTID BIGINT, ZONEDIST STRING, size INT", split=True)
    return ft.with_envelope(features).select(
        "OBJECTID", "ZONEDIST", "size", F.round("xmin", 9).alias("west"), F.round("ymax", 9).alias("north"),
        F.expr(f"size({geo.vertices('geometry.parts')})").alias("n_vertices"),
    )


#: Boxes from a metre or so to the whole world.
ANY_SIZE = """boxes AS (SELECT point_id AS tile, lon - w AS ax0, lat - h AS ay0, lon + w AS ax1, lat + h AS ay1
    FROM (SELECT *, CASE WHEN point_id % 500 = 0 THEN {world} ELSE {small} * power({two}, point_id % 9) END AS w,
                 CASE WHEN point_id % 500 = 0 THEN {world} / 2 ELSE {small} * power({two}, point_id % 7) END AS h FROM points) AS p)"""


@query("any_size_join", with_inputs("buildings", "points") + ", " + ANY_SIZE.format(world=num(180.0), small=num(0.00001), two=num(2.0)) + """
    SELECT b.id, tile FROM buildings AS b JOIN boxes ON b.xmin <= ax1 AND b.xmax >= ax0 AND b.ymin <= ay1 AND b.ymax >= ay0""")
def any_size_join(spark, sf_dir):
    p = load(spark, sf_dir, "points")
    whole = "point_id % 500 = 0"
    sized = p.selectExpr(
        "*", f"CASE WHEN {whole} THEN 180D ELSE 0.00001D * power(2D, point_id % 9) END AS w",
        f"CASE WHEN {whole} THEN 90D ELSE 0.00001D * power(2D, point_id % 7) END AS h",
    )
    box = F.expr(geo.box_polygon("lon - w", "lat - h", "lon + w", "lat + h"))
    boxes = sized.select(F.col("point_id").alias("tile"), box.alias("aoi"))
    shapes = buildings(spark, sf_dir).select("id", "geometry")
    return cv.aoi_join(shapes, boxes, cell=0.00001, columns=["id", "tile"]).select("id", "tile")


@query("overlay_convex", with_inputs("buildings", "points") + f""", {AOI}
    SELECT b.id, tile, round((least(b.xmax, ax1) - greatest(b.xmin, ax0)) * (least(b.ymax, ay1) - greatest(b.ymin, ay0)) * 1e8, 3) AS area
    FROM buildings AS b JOIN aoi ON b.xmin < ax1 AND b.xmax > ax0 AND b.ymin < ay1 AND b.ymax > ay0""")
def overlay_convex(spark, sf_dir):
    """Each box cut into three convex tiles by two slanting lines, in either direction: areas add up to those of the box."""
    p = load(spark, sf_dir, "points").withColumn("w", F.expr("CAST(100 + point_id % 300 AS DOUBLE) / 100000.0D"))
    west, south, east, north = "(lon - w)", "(lat - w)", "(lon + w)", "(lat + w)"
    low, high = (f"({south} + {a} * w)" for a in ("0.3D", "1.2D"))
    pieces = [
        [(west, south), (east, south), (east, low), (west, high), (west, south)],
        [(west, high), (west, north), (east, low), (west, high)],
        [(east, low), (east, north), (west, north), (east, low)],
    ]
    shapes = ", ".join(geo.polygon(piece) for piece in pieces)
    tiles = p.select(F.col("point_id").cast("int").alias("tile"), F.expr(f"explode(array({shapes}))").alias("tile_geometry"))
    shapes = buildings(spark, sf_dir).select("id", "geometry")
    return cv.overlay_convex(shapes, tiles, measures={"area": geo.parts_area}, by=("id", "tile"), scaled=(1e8, 3))


# ---------------------------------------------------------------- states of cells

STATE_SQL = f""", {COVER}, kept AS (SELECT *, size AS v FROM hits WHERE id % 5 <> 1),
    binned AS (SELECT row, col, floor(size / 3) AS bin, count(*) AS k FROM kept GROUP BY ALL),
    shares AS (SELECT row, col, greatest(ln(sum(k)) - sum(k * ln(k)) / sum(k), 0) AS entropy FROM binned GROUP BY row, col),
    coded AS (SELECT row, col, size % 4 AS code, count(*) AS k FROM kept GROUP BY ALL),
    modes AS (SELECT row, col, arg_min(code, -k * 10 + code) AS mode FROM coded GROUP BY row, col),
    agg AS (SELECT row, col, avg(v) AS mean, stddev_pop(v) AS std_dev, count(*) AS count FROM kept GROUP BY row, col)
    SELECT row, col, round(coalesce(mean, 0), 6) AS mean, round(coalesce(std_dev, -1), 6) AS std_dev, coalesce(count, 0) AS count,
           least(coalesce(count, 0), 1) AS presence, CAST(coalesce(mode, -1) AS INT) AS mode, round(entropy, 6) AS entropy
    FROM cells LEFT JOIN agg USING (row, col) LEFT JOIN modes USING (row, col) LEFT JOIN shares USING (row, col)"""


@query("cell_states_merged", with_inputs("zones") + STATE_SQL)
def cell_states_merged(spark, sf_dir):
    """A stored state, later features and taken ones: as if all that is left had been run at once."""
    cover = zone_cover(spark, sf_dir)
    value, code = F.col("size"), F.expr("size % 4")
    path = fresh_path(spark, "cell-states")
    writers.write_parquet(cs.cell_states(cover.where("id % 5 <= 2"), value, code), path)
    added = cs.cell_states(cover.where("id % 5 > 2"), value, code)
    taken = cs.cell_states(cover.where("id % 5 = 1"), value, code, sign=-1)
    return rounded(cs.state_on_grid(cs.merge_states(spark.read.parquet(path), added, taken), G))
