"""Inputs of the checked queries, derived from the given tables.

Each input is one SELECT that Spark and the checking SQL both understand; only the word
for integer division differs. All keys and offsets are integer arithmetic, so both sides
see the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraquilt.functions import geometry as geo
from terraquilt.grid import GridSpec

BBOX = (-74.01, 40.75, -73.86, 40.88)


def num(value: float) -> str:
    """Exact DOUBLE literal in either dialect."""
    return f"CAST('{value!r}' AS DOUBLE)"


_PER = num(100000.0)
_RECT_X = f"{num(-74.02)} + CAST(p_partkey * 7919 % 17000 AS DOUBLE) / {_PER}"
_RECT_Y = f"{num(40.74)} + CAST(p_partkey * 104729 % 15000 AS DOUBLE) / {_PER}"


def _rect(extra: str, side: str, where: str = "") -> str:
    return (
        f"SELECT *, xmin + side AS xmax, ymin + side AS ymax FROM (SELECT p_partkey AS id, {extra}, "
        f"{_RECT_X} AS xmin, {_RECT_Y} AS ymin, CAST({side} AS DOUBLE) / {_PER} AS side FROM {{part}}{where}) AS r"
    )


TEMPLATES = {
    "monthly": """
        SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
               o_orderpriority AS gas,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS average,
               min(o_totalprice) AS deseasonalized
        FROM {orders} GROUP BY 1, 2, 3""",
    "pixels": """
        SELECT {grid_id} AS raster_id, {band_1} AS band, CAST(event_id {div} 100 AS INT) AS row,
               CAST(event_id % 100 AS INT) AS col, value
        FROM {events}""",
    "holes": """
        SELECT {grid_id} AS raster_id, {band_1} AS band, CAST(event_id {div} 100 AS INT) AS row,
               CAST(event_id % 100 AS INT) AS col, value
        FROM {events} WHERE event_type <> 'error'""",
    "spectral": """
        SELECT {scene_id} AS raster_id, CAST(event_id {div} 100 AS INT) AS row,
               CAST(event_id % 100 AS INT) AS col,
               CAST(200 + event_id * 37 % 3001 AS DOUBLE) AS red,
               CAST(150 + event_id * 53 % 2503 AS DOUBLE) AS blue,
               CAST(180 + event_id * 71 % 2707 AS DOUBLE) AS green,
               CAST(300 + event_id * 97 % 4001 AS DOUBLE) AS nir,
               CAST(250 + event_id * 113 % 3511 AS DOUBLE) AS swir16,
               CAST(220 + event_id * 131 % 3203 AS DOUBLE) AS swir22
        FROM {events}""",
    "sources": """
        SELECT {grid_id} AS raster_id, {band_1} AS band, CAST(event_id {div} 100 AS INT) AS row,
               CAST(event_id % 100 AS INT) AS col,
               CASE WHEN event_type = 'purchase' AND value > 150 THEN CAST(1 AS DOUBLE)
                    ELSE CAST(0 AS DOUBLE) END AS value
        FROM {events}""",
    "zone_counts": """
        SELECT CAST(event_id {div} 100 AS INT) AS row, CAST(event_id % 100 AS INT) AS col,
               CASE WHEN event_type = 'view' AND value > 140 THEN 2 ELSE 0 END AS has_residence,
               CASE WHEN event_type = 'click' AND value > 160 THEN 1 ELSE 0 END AS has_manufacture,
               CASE WHEN event_type = 'purchase' AND value > 150 THEN 1 ELSE 0 END AS has_commercial,
               CASE WHEN event_type = 'signup' AND value > 170 THEN 3 ELSE 0 END AS has_park
        FROM {events}""",
    "buildings": _rect(
        """
        CAST((1 + p_partkey % 5) * 1000000 + p_partkey AS STRING) AS bin,
        CASE WHEN p_partkey % 31 = 0 THEN NULL
             ELSE CAST(1900 + p_partkey * 7 % 130 AS STRING) END AS cnstrct_yr,
        CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_size AS STRING) END AS heightroof,
        CASE p_partkey % 3 WHEN 0 THEN '1006' WHEN 1 THEN '2100' ELSE '5100' END AS feat_code,
        CASE p_partkey % 11 WHEN 0 THEN '2021-07-24 00:00:00' WHEN 1 THEN '2021-07-23 23:59:59'
             WHEN 2 THEN 'unknown' ELSE '2017-08-22 00:00:00' END AS lstmoddate,
        CASE WHEN p_partkey % 7 = 0 THEN 'Demolition' ELSE 'Constructed' END AS lststatype,
        p_brand AS base_bbl, p_type AS mpluto_bbl""",
        "5 + p_partkey % 20",
    ),
    "zones": _rect(
        """
        CASE p_partkey % 6 WHEN 0 THEN 'C1-2' WHEN 1 THEN 'M1-1' WHEN 2 THEN 'PARK' WHEN 3 THEN 'R10H'
             WHEN 4 THEN 'R7-2' ELSE 'C6-4.5' END AS ZONEDIST,
        CASE p_partkey % 3 WHEN 0 THEN 'C1-2' WHEN 1 THEN 'C2-4' ELSE 'C1-5' END AS OVERLAY,
        CASE p_partkey % 4 WHEN 0 THEN 'MX-9' WHEN 1 THEN 'MiD' WHEN 2 THEN '125th' ELSE 'EC-2' END AS SDLBL,
        p_size AS size""",
        "50 + p_partkey % 400",
    ),
    "streets": f"""
        SELECT *, xfrom + (id * 31 % 41 - 20) / {_PER} AS xto, yfrom + (id * 43 % 37 - 18) / {_PER} AS yto
        FROM (SELECT p_partkey AS id, {_RECT_X} AS xfrom, {_RECT_Y} AS yfrom,
            CASE p_partkey % 8 WHEN 1 THEN '5' WHEN 2 THEN 'A' WHEN 3 THEN NULL WHEN 4 THEN 'C'
                 WHEN 5 THEN 'F' ELSE '0' END AS FeatureTyp,
            CASE p_partkey % 6 WHEN 0 THEN 'G' WHEN 1 THEN 'B' WHEN 2 THEN 'R' ELSE 'U' END AS SegmentTyp,
            CASE WHEN p_partkey % 10 = 0 THEN '3' ELSE '2' END AS Status,
            CONCAT(' ', CAST(1 + p_partkey % 14 AS STRING), ' ') AS RW_TYPE,
            CASE p_partkey % 4 WHEN 0 THEN 'T' WHEN 1 THEN 'A' WHEN 2 THEN 'W' ELSE 'P' END AS TrafDir,
            CASE WHEN p_partkey % 6 = 0 OR p_partkey % 14 = 12 THEN NULL
                 ELSE CAST(20 + p_partkey * 17 % 43 AS INT) END AS StreetWidth_Min,
            CASE WHEN p_partkey % 9 = 0 OR p_partkey % 14 = 12 THEN NULL
                 ELSE CAST(24 + p_partkey * 29 % 59 AS INT) END AS StreetWidth_Max,
            CASE WHEN p_partkey % 5 = 0 THEN '  '
                 ELSE CONCAT(' ', CAST(1 + p_partkey % 6 AS STRING), ' ') END AS Number_Total_Lanes,
            CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE ' TW' END AS BIKE_TRAFDIR,
            CAST(980000 + p_partkey * 7919 % 40000 AS DOUBLE) AS feet_x,
            CAST(190000 + p_partkey * 104729 % 60000 AS DOUBLE) AS feet_y,
            CAST((p_partkey * 31 % 41 - 20) * 10 AS DOUBLE) AS feet_dx,
            CAST((p_partkey * 43 % 37 - 18) * 10 AS DOUBLE) AS feet_dy
          FROM {{part}}) AS s""",
    "points": f"""
        SELECT c_custkey AS point_id,
               {num(-74.01)} + CAST(c_custkey * 7919 % 15000 AS DOUBLE) / {_PER} AS lon,
               {num(40.75)} + CAST(c_custkey * 6101 % 13000 AS DOUBLE) / {_PER} AS lat
        FROM {{customer}}""",
    "codes": """
        SELECT c_custkey AS id, CASE c_custkey % 8
            WHEN 0 THEN CAST(1000010010 + c_custkey AS STRING) WHEN 1 THEN '1-00001-0010'
            WHEN 2 THEN '1/00001/0010' WHEN 3 THEN '1000010010;1000010011'
            WHEN 4 THEN '1000010010, 1000010011' WHEN 5 THEN '1 00001 0010'
            WHEN 6 THEN NULL ELSE c_name END AS code
        FROM {customer}""",
}

# Raster keys depend on a column, as in a stored pixel table. Plain literals would be folded
# away and turn equi-joins on them into nested loops.
RASTER_KEYS = {
    "grid_id": "CASE WHEN event_id >= 0 THEN 'grid' END",
    "band_1": "CASE WHEN event_id >= 0 THEN 1 END",
    "scene_id": "CASE WHEN event_id >= 0 THEN 'landsat_8' END",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def checking_sql(name: str) -> str:
    """The input as SQL over the registered views."""
    return TEMPLATES[name].format(div="//", **RASTER_KEYS, **{t: t for t in TABLES})


def with_inputs(*names: str) -> str:
    """Leading WITH clause that defines the named inputs."""
    return "WITH " + ", ".join(f"{n} AS ({checking_sql(n)})" for n in names)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input as a DataFrame over the Parquet tables of a directory."""
    paths = {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in TABLES}
    return spark.sql(TEMPLATES[name].format(div="div", **RASTER_KEYS, **paths))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shaped(df: DataFrame, shape: str, geometry: str = "geometry") -> DataFrame:
    """Add a geometry as a value of the row, as if it had been stored."""
    return df.select("*", F.expr(f"inline(array(named_struct('{geometry}', {shape})))"))


def rectangles(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Replace the four rectangle columns by a geometry."""
    shaped = _shaped(df, geo.box_polygon("xmin", "ymin", "xmax", "ymax"), geometry)
    return shaped.drop("xmin", "ymin", "xmax", "ymax", "side")


def buildings(spark, sf_dir) -> DataFrame:
    """Building records as delivered, with rectangle geometry."""
    return rectangles(load(spark, sf_dir, "buildings"))


def zones(spark, sf_dir) -> DataFrame:
    return rectangles(load(spark, sf_dir, "zones"))


def triangles(spark, sf_dir) -> DataFrame:
    """Lower-left triangle of every zone rectangle: the points whose offsets from its corner add up to its side at most.

    ``xmin + side`` may round up to a value beyond the side; then the corner is the next one below, the last that
    the triangle holds.
    """
    def corner(low: str, high: str) -> str:
        return f"IF({high} - {low} > side, {high} - power(2D, floor(log2(abs({high}))) - 52), {high})"

    east, north = corner("xmin", "xmax"), corner("ymin", "ymax")
    shape = geo.polygon([("xmin", "ymin"), (east, "ymin"), ("xmin", north), ("xmin", "ymin")])
    return _shaped(load(spark, sf_dir, "zones"), shape).select("id", "geometry")


def donuts(spark, sf_dir) -> DataFrame:
    """Zone rectangles with a hole over their middle half."""
    hole = geo.box_ring("xmin + side / 4", "ymin + side / 4", "xmax - side / 4", "ymax - side / 4")
    shape = geo.polygon(geo.box_ring("xmin", "ymin", "xmax", "ymax"), hole)
    return _shaped(load(spark, sf_dir, "zones"), shape).select("id", "geometry")


def streets(spark, sf_dir) -> DataFrame:
    """Street segments: line geometry in degrees, end points in feet, padded text attributes."""
    s = load(spark, sf_dir, "streets")
    shape = geo.line(("xfrom", "yfrom"), ("xto", "yto"))
    return _shaped(s, shape).drop("xfrom", "yfrom", "xto", "yto").withColumnsRenamed(
        {"id": "OBJECTID", "feet_x": "XFrom", "feet_y": "YFrom"}
    ).withColumns({"XTo": F.col("XFrom") + F.col("feet_dx"), "YTo": F.col("YFrom") + F.col("feet_dy")}).drop(
        "feet_dx", "feet_dy"
    )


def grid(resolution: float) -> GridSpec:
    return GridSpec.from_bbox(BBOX, resolution)


def cells_sql(g: GridSpec) -> str:
    """Cells of a grid with their edges, as SQL."""
    return (
        f"SELECT CAST(r.i AS INT) AS row, CAST(c.i AS INT) AS col, "
        f"{num(g.x0)} + c.i * {num(g.px)} AS cx0, {num(g.x0)} + (c.i + 1) * {num(g.px)} AS cx1, "
        f"{num(g.y1)} - (r.i + 1) * {num(g.py)} AS cy0, {num(g.y1)} - r.i * {num(g.py)} AS cy1 "
        f"FROM range(0, {g.height}) AS r(i), range(0, {g.width}) AS c(i)"
    )


def pixel_height(spark, sf_dir) -> int:
    """Rows of the 100-column pixel grid: one number from the table's statistics."""
    return table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 100 + 1
