"""Geometry, covers and joins against small hand-made or brute-force cases."""

import json
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from terraquilt.functions import crs, geometry as geo
from terraquilt.grid import GridSpec
from terraquilt.operators import cover, features
from terraquilt.plans.fixtures import BBOX
from terraquilt.sources import readers, writers

GRID = GridSpec(0.0, 10.0, 1.0, 1.0, 10, 10)


def shapes(spark, rows):
    """(id, type, rings) with rings as lists of (x, y)."""
    data = [(i, (kind, [[[tuple(map(float, p)) for p in ring] for ring in rings]])) for i, kind, rings in rows]
    return spark.createDataFrame(data, f"id int, geometry {geo.GEOMETRY_DDL}")


def cells_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.id, set()).add((r.row, r.col))
    return out


def segment_meets_box(a, b, box):
    """Cut the segment to the box; something is left if they meet."""
    t0, t1 = 0.0, 1.0
    for p, d, low, high in ((a[0], b[0] - a[0], box[0], box[2]), (a[1], b[1] - a[1], box[1], box[3])):
        if d == 0:
            if p < low or p > high:
                return False
            continue
        near, far = sorted(((low - p) / d, (high - p) / d))
        t0, t1 = max(t0, near), min(t1, far)
    return t0 <= t1


def inside(x, y, rings):
    hit = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                hit = not hit
    return hit


def expected_cover(kind, rings):
    out = set()
    for row in range(10):
        for col in range(10):
            box = (col, 9 - row, col + 1, 10 - row)
            edges = [e for ring in rings for e in zip(ring, ring[1:])]
            if any(segment_meets_box(a, b, box) for a, b in edges) or (
                kind == "Polygon" and inside(box[0], box[1], rings)
            ):
                out.add((row, col))
    return out


@pytest.mark.parametrize("block", [1, 3, 64])
def test_cover_matches_brute_force(spark, block):
    rng = np.random.default_rng(5)
    rows = [
        (0, "Polygon", [[(0.2, 0.2), (9.7, 0.3), (9.5, 9.6), (0.4, 9.1), (0.2, 0.2)],
                        [(2.5, 2.5), (2.5, 7.5), (7.5, 7.5), (7.5, 2.5), (2.5, 2.5)]]),
        (1, "LineString", [[(0.1, 0.1), (9.9, 9.7), (3.3, 9.2)]]),
        (2, "Polygon", [[(3, 3), (5, 3), (5, 5), (3, 5), (3, 3)]]),
        (3, "Polygon", [[(-5, -5), (-1, -5), (-1, -1), (-5, -1), (-5, -5)]]),
        (4, "Polygon", [[(-50, -50), (50, -50), (50, 50), (-50, 50), (-50, -50)]]),
        (5, "LineString", [[(4.0, 2.0), (4.0, 6.0)]]),
    ]
    for i in range(6, 30):
        points = [tuple(p) for p in rng.uniform(-2, 12, (3, 2))]
        rows.append((i, "Polygon", [points + points[:1]]))
    got = cells_of(cover.cover_cells(shapes(spark, rows), GRID, block=block))
    for i, kind, rings in rows:
        assert got.get(i, set()) == expected_cover(kind, rings), i


def test_cell_statistics_defaults(spark):
    covered = spark.createDataFrame([(0, 0, 5.0), (0, 1, 1.0), (0, 1, 4.0), (0, 1, 4.0)], "row int, col int, v double")
    grid = GridSpec(0.0, 1.0, 1.0, 1.0, 3, 1)
    stats = cover.cell_statistics(
        covered.withColumn("k", F.col("v").cast("int")),
        {"m": ("mean", F.col("v")), "s": ("std_dev", F.col("v")), "o": ("mode", F.col("k")), "n": ("count", F.col("v"))},
        grid,
    )
    got = {r.col: (r.m, r.s, r.o, r.n) for r in stats.collect()}
    assert got[0] == (5.0, 0.0, 5, 1)
    assert got[1] == (3.0, pytest.approx(math.sqrt(2)), 4, 3)
    assert got[2] == (0.0, -1.0, -1, 0)


def test_cell_mode_smallest_on_ties(spark):
    covered = spark.createDataFrame([(0, 0, 7), (0, 0, 3), (0, 0, 9), (0, 0, 9), (0, 0, 3)], "row int, col int, v int")
    got = cover.cell_mode(covered, F.col("v"), GridSpec(0, 1, 1, 1, 1, 1)).first()
    assert got.mode == 3


def test_unknown_statistic_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown statistic"):
        cover.statistic("median", F.col("v"))


def test_cell_entropy_bins(spark):
    values = [0.0, 2.9, 3.0, 179.9, 180.0, -1.0]
    covered = spark.createDataFrame([(0, 0, v) for v in values], "row int, col int, v double")
    got = cover.cell_entropy(covered, F.col("v"), GridSpec(0, 1, 1, 1, 2, 1)).orderBy("col").collect()
    p = np.array([2, 1, 1]) / 4
    assert got[0].entropy == pytest.approx(-(p * np.log(p)).sum())
    assert got[1].entropy is None


def test_clip_areas_add_up_to_the_polygon(spark):
    # an irregular polygon with a hole, over several cells of a degree grid
    grid = GridSpec.from_bbox(BBOX, 100)
    ring = [(-73.993, 40.760), (-73.989, 40.7605), (-73.990, 40.764), (-73.991, 40.762), (-73.993, 40.760)]
    hole = [(-73.991, 40.7610), (-73.991, 40.7615), (-73.9905, 40.7615), (-73.991, 40.7610)]
    shape = shapes(spark, [(0, "Polygon", [ring, hole])])
    total = shape.select(features.polygon_area_sqft().alias("a")).first().a
    clipped = cover.cover_cells(shape, grid).select(cover.clip_area_sqft(grid).alias("a"))
    n, parts = clipped.agg(F.count("a"), F.sum("a")).first()
    assert n > 10
    # sides that are straight in degrees bend slightly in feet, hence not to the last digit
    assert parts == pytest.approx(total, rel=1e-5)


def test_ring_orientation_and_area(spark):
    square = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]
    hole = [(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1), (0.5, 0.5)]
    df = shapes(spark, [(0, "Polygon", [square, hole])])
    r = df.select(
        F.expr(geo.parts_area("geometry.parts")).alias("area"),
        F.expr(f"transform({geo.orient_parts('geometry.parts')}[0], r_ -> {geo.signed_ring_area('r_')})").alias("signed"),
    ).first()
    assert r.area == pytest.approx(3.75)
    assert r.signed == pytest.approx([4.0, -0.25])


def test_state_plane_known_answers(spark):
    df = spark.createDataFrame([(-74.0, 40 + 10 / 60), (-73.9855, 40.758), (None, 40.0)], "lon double, lat double")
    rows = df.select(F.expr(crs.to_state_plane("lon", "lat")).alias("p")).collect()
    assert (rows[0].p.x, rows[0].p.y) == pytest.approx((984250.0, 0.0), abs=1e-6)
    assert (rows[1].p.x, rows[1].p.y) == pytest.approx((988267.0741, 215436.8785), abs=1e-3)
    assert rows[2].p.x is None
    back = df.select("lon", "lat", F.expr(crs.to_state_plane("lon", "lat")).alias("p")).select(
        "lon", "lat", F.expr(crs.from_state_plane("p.x", "p.y")).alias("d")
    ).collect()
    for r in back[:2]:
        assert (r.d.lon, r.d.lat) == pytest.approx((r.lon, r.lat), abs=1e-11)
    assert back[2].d.lon is None and back[2].d.lat is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(-75, -72), st.floats(40, 42)), min_size=1, max_size=20))
def test_transforms_invert(spark, points):
    df = spark.createDataFrame(points, "lon double, lat double")
    for srid in (2263, 3857):
        there = df.withColumn("p", F.expr(crs.transform_xy("lon", "lat", 4326, srid)))
        back = there.select("lon", "lat", F.expr(crs.transform_xy("p.x", "p.y", srid, 4326)).alias("d"))
        for r in back.collect():
            assert (r.d.x, r.d.y) == pytest.approx((r.lon, r.lat), abs=1e-9)


def test_unknown_reference_system():
    with pytest.raises(ValueError, match="EPSG:25832"):
        crs.transform_xy("x", "y", 25832, 4326)


@pytest.mark.parametrize("resolution, size", [
    (5, (3341, 2895)), (10, (1671, 1448)), (30, (558, 483)), (100, (168, 146)), (200, (84, 73)), (500, (34, 30)), (1000, (18, 15)),
])
def test_grid_sizes(resolution, size):
    grid = GridSpec.from_bbox(BBOX, resolution)
    assert (grid.width, grid.height) == size


def test_bbox_predicates_at_the_edge(spark):
    bbox = (0, 0, 10, 10)
    rows = [
        (0, "Polygon", [[(0, 0), (1, 0), (1, 1), (0, 0)]]),          # inside, touching
        (1, "Polygon", [[(9, 9), (11, 9), (11, 11), (9, 9)]]),       # crossing
        (2, "LineString", [[(0, 0), (0, 5)]]),                       # along the border
        (3, "LineString", [[(0, 5), (0, 0), (5, 0)]]),               # along two borders
        (4, "LineString", [[(0, 5), (5, 0)]]),                       # across, ends on the border
        (5, "Polygon", [[(10, 0), (12, 0), (12, 2), (10, 0)]]),      # touching from outside
        (6, "Polygon", [[(11, 11), (12, 11), (12, 12), (11, 11)]]),  # outside
        (7, "LineString", [[(-1, 12), (12, -1)]]),                   # envelope overlaps, line crosses
        (8, "LineString", [[(9, 13), (13, 9)]]),                     # envelope overlaps, line misses
    ]
    df = shapes(spark, rows)
    ids = lambda d: {r.id for r in d.collect()}
    assert ids(features.bbox_contains(df, bbox)) == {0, 4}
    assert ids(features.bbox_intersects(df, bbox)) == {0, 1, 2, 3, 4, 5, 7}
    assert ids(features.bbox_contains(features.with_envelope(df), bbox)) == {0, 4}


def test_geojson_round_trip_and_parts(spark, tmp_path):
    collection = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "1", "properties": {"name": "a", "n": 1},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "id": "2", "properties": {"name": "b", "n": None},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]],
                                                               [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "id": "3", "properties": {"name": "c", "n": 3}, "geometry": None},
        {"type": "Feature", "id": "4", "properties": {"name": "d", "n": 4},
         "geometry": {"type": "LineString", "coordinates": [[0.5, 0.25], [1, 1]]}},
    ]}
    path = tmp_path / "collection.geojson"
    path.write_text(json.dumps(collection, indent=1))
    parts = readers.read_features(spark, str(path), "name STRING, n INT")
    rows = parts.orderBy("name").collect()
    assert [r.name for r in rows] == ["a", "b", "c", "d"]
    assert [len(r.geometry.parts) for r in rows[:2]] == [1, 2]
    assert rows[2].geometry is None and rows[3].geometry.parts[0][0][0].y == 0.25
    out = str(tmp_path / "lines")
    writers.write_features(parts, out)
    back = readers.read_features(spark, out, "id STRING, name STRING, n INT", multiline=False)
    assert back.count() == 4
    again = {r.name: r.geometry for r in back.collect()}
    assert again == {r.name: r.geometry for r in rows}
    line = spark.read.text(out).where(F.col("value").contains('"name":"d"')).first().value
    assert json.loads(line) == {
        "type": "Feature", "properties": {"id": "4", "name": "d", "n": 4},
        "geometry": {"type": "LineString", "coordinates": [[0.5, 0.25], [1.0, 1.0]]},
    }


def test_a_shape_of_two_parts_counts_once_per_cell(spark):
    left = [(1.1, 1.1), (1.4, 1.1), (1.4, 1.4), (1.1, 1.1)]
    right = [(1.6, 1.6), (2.5, 1.6), (2.5, 1.9), (1.6, 1.6)]
    parts = [[[tuple(p) for p in left]], [[tuple(p) for p in right]]]
    shape = spark.createDataFrame([(0, ("Polygon", parts))], f"id int, geometry {geo.GEOMETRY_DDL}")
    got = cover.cover_cells(shape, GRID).select("row", "col").collect()
    assert sorted(map(tuple, got)) == [(8, 1), (8, 2)]
    area = shape.select(F.expr(geo.parts_area("geometry.parts")).alias("a")).first().a
    assert area == pytest.approx(0.045 + 0.135)


def test_overlay_intersection_clips_to_the_tile(spark):
    triangle = shapes(spark, [(0, "Polygon", [[(0, 0), (4, 0), (0, 4), (0, 0)]])])
    tiles = spark.range(1).select(
        F.explode(F.array(*[F.struct(F.lit(t).alias("tile"), F.expr(geo.bbox_polygon(b)).alias("aoi")) for t, b in (
            (1, (1, 1, 2, 2)), (2, (3, 0, 5, 1)), (3, (3, 3, 5, 5)), (4, (-1, -1, 9, 9)),
        )])).alias("t")
    ).select("t.*")
    pieces = cover.overlay_intersection(triangle, tiles, cell=1.0)
    got = {r.tile: r.a for r in pieces.select("tile", F.expr(geo.parts_area("geometry.parts")).alias("a")).collect()}
    assert got == pytest.approx({1: 1.0, 2: 0.5, 4: 8.0})
