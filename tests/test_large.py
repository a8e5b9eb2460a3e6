"""What keeps large inputs apart: split files, bins of several levels, dealt-out keys, wide medians, tile ranges, cell states."""

import json
import random
from collections import Counter

import __spark_entry__ as contract
import check
import duckdb
import numpy as np
import pytest
from conftest import pixel_table
from pyspark.sql import functions as F

from terraquilt.functions import crs, geometry as geo, planar
from terraquilt.grid import GridSpec
from terraquilt.operators import cover, focal, labels, raster, sampling, skew, warp
from terraquilt.session import fresh_path, small_table
from terraquilt.sources import json_split, readers, writers
from terraquilt.streaming import cell_states as states


# ---------------------------------------------------------------- split files

@pytest.fixture
def tiny_blocks(spark):
    """Blocks of a few dozen bytes, several to a task and to a batch."""
    settings = {
        "spark.sql.files.maxPartitionBytes": "61b", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "3",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def tricky(rng, i):
    text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "漢", " ", "\n", "a", "features", '"features": ['])
                   for _ in range(rng.randrange(0, 60)))
    return {"id": i, "text": text, "nested": {"list": [{"x": text[:5]}, [1, [2]], {}], text[:3] + "k": "}"}, "z": rng.random() < 0.5}


def dumped(rng, value):
    return json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1, 3]), separators=rng.choice([None, (",", ":")]))


def kept(rows):
    return Counter(json.dumps(json.loads(r.value), sort_keys=True) for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_objects_of_arrays_and_lines_in_many_blocks(spark, tiny_blocks, tmp_path, seed):
    rng = random.Random(seed)
    want = Counter()
    for name in ("a", "b"):
        records = [tricky(rng, i) for i in range(12)]
        want.update(json.dumps(r, sort_keys=True) for r in records)
        others = [3, "} {", ["]", {"no": 1}], None, [{"id": 0}]]
        (tmp_path / f"{name}.json").write_text(dumped(rng, [*records[:5], *others, *records[5:], [{"open": "x" * 200}]]) + "\n")
    lines = [tricky(rng, i) for i in range(5)]
    want.update(json.dumps(r, sort_keys=True) for r in lines)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in lines))
    for name, text in (("none", ""), ("blank", " \n"), ("empty", "[]"), ("lone", "[{}]")):
        (tmp_path / f"{name}.json").write_text(text)
    want["{}"] += 1
    assert kept(json_split.read_objects(spark, str(tmp_path)).collect()) == want
    blocks = json_split._blocks(spark, str(tmp_path)).select("file", "block").distinct().count()
    assert blocks > 40


@pytest.mark.parametrize("seed", range(3))
def test_objects_under_a_key_in_many_blocks(spark, tiny_blocks, tmp_path, seed):
    rng = random.Random(seed + 10)
    records = [tricky(rng, i) for i in range(30)]
    head = {"type": "features", "crs": {"features": [{"id": "not this"}], "p": {"q": {"r": 1}}}, "list": [{"id": "nor this"}] * 4}
    whole = head | {"features": records} | {"after": [{"id": "no"}, tricky(rng, 0)], "features2": [{"id": "no"}]}
    (tmp_path / "c.json").write_text(dumped(rng, whole))
    (tmp_path / "without.json").write_text(dumped(rng, head))
    found = json_split.read_objects(spark, str(tmp_path), "features").collect()
    assert kept(found) == Counter(json.dumps(r, sort_keys=True) for r in records)


def test_split_readers_give_the_rows_of_the_whole_file_readers(spark, tmp_path):
    rng = random.Random(4)
    features = [
        {"type": "Feature", "id": str(i), "properties": {"name": rng.choice(['a"}', None, "]"]), "n": i},
         "geometry": rng.choice([None, {"type": "Point", "coordinates": [i, 2.5]},
                                 {"type": "Polygon", "coordinates": [[[0, 0], [i, 0], [i, 1], [0, 0]]]}])} for i in range(40)
    ]
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    whole = readers.read_features(spark, str(tmp_path), "name STRING, n INT")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    split = readers.read_features(spark, str(tmp_path), "name STRING, n INT", split=True)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "records").mkdir()
    (tmp_path / "records" / "r.json").write_text(json.dumps([{"a": i, "b": {"c": [i]}} for i in range(30)], indent=2))
    schema = "a INT, b STRUCT<c: ARRAY<INT>>, missing STRING"
    path = str(tmp_path / "records")
    assert sorted(readers.read_records(spark, path, schema, split=True).collect()) == sorted(readers.read_records(spark, path, schema).collect())


# ---------------------------------------------------------------- shapes of all sizes

def test_join_of_shapes_from_metres_to_the_world_matches_all_pairs(spark):
    rng = random.Random(7)

    def boxes(n):
        out = []
        for i in range(n):
            w, h = (10 ** rng.uniform(-6, 2.3) for _ in range(2))
            x, y = rng.uniform(-180, 180), rng.uniform(-90, 90)
            if rng.random() < 0.3:
                x, y, w, h = float(round(x)), float(round(y)), 2.0 ** rng.randrange(-3, 6), 0.0  # borders on bin borders, lines
            out.append((i, x, y, x + w, y + h))
        return out

    left, right = boxes(150), boxes(120)
    def shaped(rows, name, column):
        df = spark.createDataFrame(rows, f"{name} int, x0 double, y0 double, x1 double, y1 double")
        return df.select(name, F.expr(geo.box_polygon("x0", "y0", "x1", "y1")).alias(column))
    a, b = shaped(left, "a", "geometry"), shaped(right, "b", "aoi")
    got = cover.envelope_join(a, b, 0.0001).select("a", "b").collect()
    want = {(i, j) for i, x0, y0, x1, y1 in left for j, u0, v0, u1, v1 in right if x0 <= u1 and u0 <= x1 and y0 <= v1 and v0 <= y1}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    levels = sorted(r[0] for r in cover._leveled(b, "aoi", "r", 0.0001).select("_rl").distinct().collect())
    rows = cover._binned(cover._leveled(a, "geometry", "l", 0.0001), "l", 0.0001, levels).groupBy("a").count().collect()
    assert max(r["count"] for r in rows) <= 6 * (len(levels) + 1)


def test_convex_tiles_share_out_a_polygon(spark):
    star = geo.polygon([("0", "0"), ("4", "1"), ("8", "0"), ("6", "4"), ("8", "8"), ("4", "6"), ("0", "8"), ("2", "4"), ("0", "0")])
    shapes = spark.range(1).select("id", F.expr(star).alias("geometry"))
    corners = [(4 + 9 * np.cos(t), 4 + 9 * np.sin(t)) for t in np.linspace(0.1, 0.1 + 2 * np.pi, 8)[:-1]]
    tiles = []
    for i in range(7):  # a fan of triangles, every other one clockwise
        p, q = corners[i], corners[(i + 1) % 7]
        ring = [(4.3, 3.9), p, q, (4.3, 3.9)]
        tiles.append(geo.polygon([(str(float(x)), str(float(y))) for x, y in (ring if i % 2 else ring[::-1])]))
    fan = spark.range(1).select(F.expr(f"posexplode(array({', '.join(tiles)})) AS (tile, tile_geometry)"))
    cut = cover.overlay_convex(shapes, fan, 1.0).withColumn("area", F.expr(geo.parts_area("geometry.parts")))
    whole = shapes.select(F.expr(geo.parts_area("geometry.parts"))).first()[0]
    assert cut.agg(F.sum("area")).first()[0] == pytest.approx(whole)
    inner = [(4.3, 3.9)]
    rng = np.random.default_rng(1)
    points = rng.uniform(0, 8, (4000, 2))  # a second method: the share of random points in both
    def inside(ring, x, y):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                hit = not hit
        return hit
    outline = [(0, 0), (4, 1), (8, 0), (6, 4), (8, 8), (4, 6), (0, 8), (2, 4), (0, 0)]
    for r in cut.select("tile", "area").collect():
        ring = [*inner, corners[r.tile], corners[(r.tile + 1) % 7], *inner]
        share = np.mean([inside(outline, x, y) and inside(ring, x, y) for x, y in points]) * 64
        assert abs(share - r.area) < 1.2


# ---------------------------------------------------------------- heavy keys

def test_points_that_snap_to_one_corner_are_dealt_out(spark):
    grid = GridSpec(0.0, 10.0, 1.0, 1.0, 10, 10)
    points = spark.range(60_000).selectExpr(
        "id AS point_id", "CASE WHEN id % 3 = 0 THEN -50D - id ELSE (id * 7919 % 10000) / 1000D END AS lon",
        "CASE WHEN id % 3 = 0 THEN 99D ELSE (id * 104729 % 10000) / 1000D END AS lat",
    )
    pixels = spark.range(100).selectExpr(
        "'r' AS raster_id", "1 AS band", "CAST(id div 10 AS INT) AS row", "CAST(id % 10 AS INT) AS col", "CAST(id AS DOUBLE) AS value"
    )
    cells = sampling.point_cells(points, {"r": grid})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    joined = skew.salted_join(cells, pixels, ["raster_id", "row", "col"])
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    plain = [r["count"] for r in cells.join(pixels, ["raster_id", "row", "col"]).groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(tasks) == 60_000 and max(tasks) <= 2 * np.median(tasks) < max(plain)
    heavy, count = skew.heavy_keys(cells, ["raster_id", "row", "col"])
    assert count == 1 and heavy.first()["_slots"] > 4
    values = {r.point_id: r.value for r in joined.select("point_id", "value").collect()}
    assert values[0] == values[3] == 0.0 and len(values) == 60_000
    nothing = cells.limit(0)
    assert skew.salted_join(nothing, pixels, ["raster_id", "row", "col"]).count() == 0


# ---------------------------------------------------------------- wide medians

@pytest.mark.parametrize("size, shape, holes", [(1, (5, 9), 0.3), (3, (12, 7), 0.0), (25, (30, 40), 0.5), (50, (20, 70), 0.1), (2, (6, 6), 1.0)])
def test_medians_of_wide_windows(size, shape, holes):
    rng = np.random.default_rng(size)
    values = np.where(rng.random(shape) < holes, np.nan, rng.choice([rng.normal(size=shape), rng.integers(0, 4, shape)]))
    padded = np.pad(values, size, constant_values=np.nan)
    got = focal.window_medians(padded, size)
    for i in range(shape[0]):
        for j in range(shape[1]):
            window = padded[i:i + 2 * size + 1, j:j + 2 * size + 1]
            known = window[~np.isnan(window)]
            assert (np.isnan(got[i, j]) and not len(known)) or got[i, j] == np.median(known)


def test_median_across_tiles_next_to_other_statistics(spark):
    rng = np.random.default_rng(5)
    array = rng.normal(size=(70, 33))
    array[rng.random(array.shape) < 0.2] = np.nan
    pixels = pixel_table(spark, array)
    rows = focal.focal_statistics(pixels, 13, ("mean", "median", "std_dev")).collect()
    padded = np.pad(array, 13, constant_values=np.nan)
    assert len(rows) == array.size
    for r in rows:
        window = padded[r.row:r.row + 27, r.col:r.col + 27]
        assert r["median"] == pytest.approx(np.nanmedian(window)) and r["mean"] == pytest.approx(np.nanmean(window))
    lone = focal.focal_median(pixel_table(spark, np.full((2, 2), np.nan)), 4).collect()
    assert len(lone) == 4 and all(r["median"] is None and r.value is None for r in lone)


# ---------------------------------------------------------------- tiles in a window

def test_clip_reads_only_tiles_it_needs(spark):
    array = np.arange(80.0 * 96).reshape(80, 96)
    grid = GridSpec(0.0, 8.0, 0.1, 0.1, 96, 80)
    path = writers.write_raster(pixel_table(spark, array), fresh_path(spark, "tiles"), 8)
    tiles = spark.read.parquet(path)
    box = (3.05, 2.05, 4.35, 3.95)
    clipped, cropped = raster.clip_tiles(tiles, 8, grid, box)
    whole, same = raster.clip_bbox(pixel_table(spark, array), grid, box)
    key = lambda r: (r.row, r.col, r.value)
    assert sorted(map(key, clipped.collect())) == sorted(map(key, whole.collect())) and cropped == same
    rows, cols, _ = raster.clip_window(grid, box)
    needed = readers.tiles_in_window(tiles, 8, rows, cols)
    assert needed.count() == len({(r // 8, c // 8) for r in range(*rows) for c in range(*cols)}) < tiles.count() / 10
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(tile_row" in plan
    high = readers.tiles_in_window(tiles, 8, (0, 80), (0, 96), low=7000.0)
    assert high.count() == sum(array[r:r + 8, c:c + 8].max() >= 7000 for r in range(0, 80, 8) for c in range(0, 96, 8))
    assert readers.tiles_in_window(tiles, 8, (5, 5), (0, 9)).count() == 0


def test_clip_and_reproject_from_feet_loses_no_cell(spark):
    source = GridSpec(1_000_000.0, 310_000.0, 20.0, 20.0, 2500, 3500, 2263)
    box = (-73.87, 40.87, -73.86, 40.88)
    target = GridSpec(-73.87, 40.88, 0.0001, 0.0001, 100, 100)
    envelope = raster.outline_envelope(box, 4326, 2263)
    rows, cols, _ = raster.clip_window(source, envelope, 3)
    pixels = spark.range((rows[1] - rows[0]) * (cols[1] - cols[0])).selectExpr(
        "'r' AS raster_id", "1 AS band", f"CAST({rows[0]} + id div {cols[1] - cols[0]} AS INT) AS row",
        f"CAST({cols[0]} + id % {cols[1] - cols[0]} AS INT) AS col", "CAST(id % 1009 AS DOUBLE) AS value",
    )
    for method in ("nearest", "bilinear"):
        got = {(r.row, r.col): r.value for r in raster.clip_reproject(pixels, source, box, target, method).collect()}
        want = {(r.row, r.col): r.value for r in raster.reproject(pixels, source, target, method).collect()}
        assert len(want) == 10_000 and set(got) == set(want)
        assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_rasters_side_by_side_pass_without_a_shuffle_of_pixels(spark):
    pixels = spark.range(200).selectExpr("IF(id < 100, 'a', 'b') AS raster_id", "1 AS band", "CAST(id % 100 div 10 AS INT) AS row",
                                         "CAST(id % 10 AS INT) AS col", "CAST(id AS DOUBLE) AS value")
    meta = small_table(spark, [("a", 0.0, 10.0, 1.0, 1.0, 10, 10, 2), ("b", 10.0, 10.0, 1.0, 1.0, 10, 10, 1)],
                       "raster_id string, x0 double, y1 double, px double, py double, width int, height int, file_order int")
    assert raster.overlap_boxes(meta).count() == 0
    merged = raster.mosaic(pixels, meta)
    assert sorted((r.row, r.col, r.value) for r in merged.collect()) == sorted(
        (i % 100 // 10, i % 10 + (10 if i >= 100 else 0), float(i)) for i in range(200))


# ---------------------------------------------------------------- cell states

def test_base_and_delta_equal_a_full_run(spark):
    rng = random.Random(3)
    grid = GridSpec(0.0, 4.0, 1.0, 1.0, 4, 4)
    rows = [(i, rng.randrange(4), rng.randrange(4), rng.choice([None, float("nan"), rng.randrange(200) / 8, -3.5]), rng.choice([None, 1, 2, 3]))
            for i in range(300)]
    cells = spark.createDataFrame(rows, "id int, row int, col int, v double, code int")
    value, code = F.col("v"), F.col("code")
    full = states.cell_states(cells.where("id % 4 <> 1"), value, code)
    base = states.cell_states(cells.where("id < 200"), value, code)
    added = states.cell_states(cells.where("id >= 200"), value, code)
    taken = states.cell_states(cells.where("id % 4 = 1"), value, code, sign=-1)
    merged = states.merge_states(taken, base, added)
    assert sorted(map(str, merged.collect())) == sorted(map(str, states.merge_states(full).collect()))
    assert sorted(map(str, states.state_on_grid(merged, grid).collect())) == sorted(map(str, states.state_on_grid(full, grid).collect()))
    gone = states.merge_states(base, states.cell_states(cells.where("id < 200"), value, code, sign=-1))
    assert gone.count() == 0
    empty = states.state_on_grid(gone, grid).collect()
    assert len(empty) == 16 and all((r["count"], r["mean"], r.mode, r.entropy) == (0, 0.0, -1, None) for r in empty)
    touched = states.touched_cells(states.cell_states(cells.where("row = 1 AND col = 2"), value, code))
    assert [tuple(r) for r in touched.collect()] == [(1, 2)]


def test_a_state_is_read_once_for_all_statistics(spark, tmp_path):
    """Cells without number, category or value, bins that sum to nothing, and keys that come twice."""
    rng = random.Random(5)
    rows = [(rng.choice([None, 0, 1, 2]), rng.choice([None, 0, 1]), rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 4, 59]), rng.randrange(1, 4))
            for _ in range(150)]
    rows += [(8, 8, None, None, 2), (9, 9, None, 0, 2), (9, 9, None, 0, -2), (9, 9, 5, 1, 1), (9, 9, 4, 1, 1)]
    rows = [(*r, r[4] if r[3] is not None else 0, r[4] * 1.5, r[4] * 2.25) for r in rows]
    state = spark.createDataFrame(rows, "row int, col int, category int, bin int, members bigint, n bigint, s double, ss double").withColumns(
        {"s": F.col("s").cast("decimal(38,8)"), "ss": F.col("ss").cast("decimal(38,12)")})
    state.write.parquet(path := str(tmp_path / "state"))
    stored = states.state_statistics(spark.read.parquet(path))
    assert stored._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [t for _, t in stored.dtypes] == ["int", "int", "double", "double", "bigint", "bigint", "int", "double"]

    found = {(r.row, r.col): r for r in stored.collect()}
    assert set(found) == {r[:2] for r in rows}
    for cell, r in found.items():
        mine = [x for x in rows if x[:2] == cell]
        n, total, squares = (sum(x[k] for x in mine) for k in (5, 6, 7))
        assert (r["count"], r.presence) == (n, min(n, 1))
        if n:
            assert r.mean == pytest.approx(total / n) and r.std_dev == pytest.approx(max(squares / n - (total / n) ** 2, 0) ** 0.5)
        bins, codes = Counter(), Counter()
        for x in mine if None not in cell else []:
            if x[3] is not None:
                bins[x[3]] += x[5]
            if x[2] is not None:
                codes[x[2]] += x[4]
        assert r.mode == (min(codes, key=lambda c: (-codes[c], c)) if codes else None)
        k = sum(bins.values())
        assert r.entropy == (pytest.approx(max(np.log(k) - sum(v * np.log(v) for v in bins.values() if v) / k, 0)) if bins else None)


def test_a_cover_moves_no_shape_that_nobody_reads(spark, capsys):
    grid = GridSpec(0.0, 4.0, 1.0, 1.0, 4, 4)
    spark.range(1, 6).select(
        "id", F.expr(geo.box_polygon("id / 2D", "id / 3D", "id / 2D + 1", "id / 3D + 1")).alias("geometry")
    ).write.parquet(path := fresh_path(spark, "shapes"))
    covered = cover.cover_cells(spark.read.parquet(path), grid)
    covered.select("id", "row", "col").explain("formatted")
    moved = [line for line in capsys.readouterr().out.split("Exchange\n")[1:] if "RoundRobin" in line.split("\n\n")[0]]
    assert len(moved) == 1 and "geometry" not in moved[0].split("\n")[0] and "_kind" in moved[0].split("\n")[0]
    want = {(i, r, c) for i in range(1, 6) for r in range(4) for c in range(4)
            if i / 2 <= c + 1 and i / 2 + 1 >= c and i / 3 <= 4 - r and i / 3 + 1 >= 3 - r}
    assert {(x.id, x.row, x.col) for x in covered.collect()} == want
    assert {x.geometry.type for x in covered.collect()} == {"Polygon"}


# ---------------------------------------------------------------- tile to tile

@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_warped_tiles_have_the_values_of_reprojected_pixels(spark, method):
    rng = np.random.default_rng(2)
    array = rng.normal(size=(70, 55))
    array[rng.random(array.shape) < 0.1] = np.nan
    source = GridSpec(1_005_000.0, 262_000.0, 130.0, 90.0, 55, 70, 2263)
    target = GridSpec(-73.94, 40.89, 0.0004, 0.0003, 80, 90)
    pixels = pixel_table(spark, array, keep_nan=False)
    both = pixels.unionByName(pixels.withColumn("band", F.lit(2)).withColumn("value", -F.col("value")))
    tiles = writers.pixels_to_tiles(both, 16)
    got = {(r.band, r.row, r.col): r.value for r in warp.warp_tiles(tiles, 16, source, target, method, 16).collect()}
    want = {(r.band, r.row, r.col): r.value for r in raster.reproject(both, source, target, method).collect()}
    assert len(want) > 3000 and set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert warp.warp_tiles(tiles.limit(0), 16, source, target, method).count() == 0


def test_codes_of_small_and_large_label_sets_agree(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["MX-9", "MiD", "é", "", None, f"k{rng.randrange(300)}"]), rng.choice(["b", "a", None])) for _ in range(900)]
    df = spark.createDataFrame(rows, "one string, two string")
    small = labels.label_codes(df, ["one", "two"])
    large = labels._sorted_codes(labels._labels(df, ["one", "two"]))
    want = {("one", x): i for i, x in enumerate(sorted({r[0] for r in rows if r[0] is not None}, key=str.encode))} | {("two", "a"): 0, ("two", "b"): 1}
    for codes in (small, large):
        assert {(r["_column"], r["_label"]): r["_code"] for r in codes.collect()} == want


# ---------------------------------------------------------------- borders on cell borders

def test_a_triangle_reaches_no_farther_than_its_side(spark, tmp_path):
    # corners that round up onto a cell border, which the triangle itself does not reach, and some that do reach it
    keys = [6695, 7765, 9075, 10015, 14480, 24780, 34315, 35050, *range(100_000, 100_400)]
    columns = "1 AS p_size, 'b' AS p_brand, 't' AS p_type"
    duckdb.sql(f"COPY (SELECT unnest({keys})::BIGINT AS p_partkey, {columns}) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    verdict, _ = check.compare(spark, connection, str(tmp_path), "box_intersects", contract.queries(), contract.oracle_sql())
    assert verdict.startswith("ok"), verdict


# ---------------------------------------------------------------- few bins with most of the pairs

def in_tasks(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def squares(spark, n, name, side, column):
    at = spark.range(n).coalesce(1).selectExpr("id", "(id * 7919 % 1000) / 1000D AS x", "(id * 104729 % 1000) / 1000D AS y")
    return at.select(F.col("id").alias(name), F.expr(geo.box_polygon("x", "y", f"x + {side}D", f"y + {side}D")).alias(column))


def test_boxes_of_the_whole_world_are_met_by_many_tasks(spark):
    shapes = squares(spark, 3000, "a", 0.001, "geometry")
    world = spark.range(40).coalesce(1).select(
        F.col("id").alias("b"), F.expr(geo.box_polygon("-180D - id", "-90D", "180D", "90D")).alias("aoi")
    )
    met = cover.aoi_join(shapes, world, cell=0.001).select("a", "b")
    tasks = in_tasks(met)
    assert sum(tasks) == 120_000 and met.distinct().count() == 120_000
    assert max(tasks) <= 60_000 and len(tasks) >= 4


def test_crossed_join_deals_out_both_sides(spark):
    left = spark.range(2000).selectExpr("IF(id < 1500, 1L, IF(id < 1600, NULL, id)) AS k", "id AS a")
    right = spark.range(900).selectExpr("IF(id < 700, 1L, id + 1000) AS k", "id AS b")
    got = skew.crossed_join(left, right, ["k"])
    tasks = in_tasks(got)
    want = left.join(right, "k")
    assert got.count() == want.count() == 1500 * 700 + 200
    assert got.exceptAll(want).count() == 0 and max(tasks) <= 3 * 1500 * 700 / 8
    assert skew.crossed_join(left.limit(0), right, ["k"]).count() == 0


def test_a_small_file_of_shapes_is_work_for_many_tasks(spark):
    met = cover.aoi_join(squares(spark, 2000, "a", 0.01, "geometry"), squares(spark, 500, "b", 0.05, "aoi"), cell=0.05)
    tasks = in_tasks(met.select("a", "b"))
    assert len(tasks) >= 4 and max(tasks) <= sum(tasks) / 2


def test_shapes_go_to_their_blocks_in_one_exchange(spark, monkeypatch):
    """Placed shapes are written by the tasks that read them, and read again by many."""
    placed, settled = [], cover.settled
    monkeypatch.setattr(cover, "settled", lambda df, *more: placed.append((df, settled(df, *more))) or placed[-1][1])
    monkeypatch.setattr(cover, "FILE_ROWS", 100)
    shapes = squares(spark, 1000, "a", 0.01, "geometry").coalesce(1)
    odd = "(-1L, NULL), (-2L, named_struct('type', 'Polygon', 'parts', array())), (-3L, {0}), (-3L, {0}), (NULL, {0})".format(
        geo.box_polygon("0.5D", "0.5D", "0.6D", "0.6D"))
    shapes = shapes.unionByName(spark.sql(f"SELECT * FROM VALUES {odd} AS t(a, geometry)").withColumn(
        "geometry", F.col("geometry").cast(shapes.schema["geometry"].dataType)))
    boxes = squares(spark, 300, "b", 0.05, "aoi")
    found = cover.aoi_join(shapes, boxes, cell=0.05, columns=["a", "b"])
    assert [df._jdf.queryExecution().executedPlan().toString().count("Exchange") for df, _ in placed] == [0, 0]
    kept = placed[0][1]
    assert kept.count() == 1003 and kept.select(F.input_file_name()).distinct().count() >= 10
    ends = [f"{name}{end} AS {name[1]}{end}" for name in ("_l", "_r") for end in cover.ENDS]
    l, r = (df.selectExpr(f"_{side}.*", *[e for e in ends if e.startswith(f"_{side}")]) for side, (df, _) in zip("lr", placed))
    want = l.drop("geometry").join(r, F.expr("lxmin <= rxmax AND lxmax >= rxmin AND lymin <= rymax AND lymax >= rymin")).select("a", "b")
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.collect()))
    assert sum(x.a == -3 for x in found.collect()) == 2 * sum(x.a is None for x in found.collect()) > 0


def test_envelope_of_odd_shapes(spark):
    """Vertices without a number, NaN, empty and missing parts, as by a function of each vertex."""
    parts = [[[[(1.0, 2.0), (3.0, None), (None, -1.0)]], [[(-4.0, float("nan"))]]], [[[]]], [], None, [[[None, (1.0, 1.0)]]], [None]]
    shapes = spark.createDataFrame([(i, ("Polygon", p)) for i, p in enumerate(parts)], f"id int, geometry {geo.GEOMETRY_DDL}")
    each = "transform(flatten(flatten(geometry.parts)), p_ -> p_.{})"
    want = [f"array_{end}({each.format(axis)}) AS {axis}{end}" for end in ("min", "max") for axis in "xy"]
    found = shapes.select("id", F.expr(geo.envelope("geometry")).alias("e")).select("id", "e.*")
    wanted = shapes.selectExpr("id", *want)
    assert found.columns == wanted.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_shapes_of_all_kinds_meet_rectangles_as_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        points = [tuple(map(float, p)) for p in rng.integers(0, 12, 2) + rng.integers(-3, 4, (4, 2))]
        away = [(x + 5, y - 5) for x, y in points]
        ring, far = points + points[:1], away + away[:1]
        kind, parts = [
            ("Polygon", [[ring]]), ("Polygon", [[ring], [far]]), ("LineString", [[points]]), ("LineString", [[points], [away]]),
            ("Polygon", [[[(-9.0, -9.0), (20.0, -9.0), (20.0, 20.0), (-9.0, 20.0), (-9.0, -9.0)], ring]]),
        ][i % 5]
        rows.append((i, (kind, parts)))
    shapes = spark.createDataFrame(rows, f"id int, geometry {geo.GEOMETRY_DDL}")
    boxes = [(i, *map(float, p), *map(float, p + rng.integers(1, 6, 2))) for i, p in enumerate(rng.integers(-2, 13, (40, 2)))]
    frame = spark.createDataFrame(boxes, "tile int, x0 double, y0 double, x1 double, y1 double")
    frame = frame.select("tile", F.expr(geo.box_polygon("x0", "y0", "x1", "y1")).alias("aoi"))
    exact = geo.box_intersects("geometry.type", geo.geometry_edges("geometry"), tuple(f"aoi.parts[0][0][{k}].{c}" for k, c in ((0, "x"), (0, "y"), (2, "x"), (2, "y"))))
    want = {tuple(r) for r in shapes.crossJoin(frame).where(exact).select("id", "tile").collect()}
    got = [tuple(r) for r in cover.aoi_join(shapes, frame, cell=1.0).select("id", "tile").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    points = spark.createDataFrame([(0, ("Point", [[[(3.0, 3.0)]]]))], f"id int, geometry {geo.GEOMETRY_DDL}")
    inside = {i for i, x0, y0, x1, y1 in boxes if x0 <= 3 <= x1 and y0 <= 3 <= y1}
    assert inside and {r.tile for r in cover.aoi_join(points, frame, cell=1.0).collect()} == inside


def test_pieces_have_the_measures_of_their_geometry(spark):
    shapes = squares(spark, 400, "a", 0.02, "geometry")
    tiles = squares(spark, 60, "b", 0.07, "aoi")
    slanted = tiles.select("b", F.expr(
        "named_struct('type', 'Polygon', 'parts', transform(aoi.parts, g_ -> transform(g_, r_ -> array(r_[0], r_[1], r_[2], r_[0]))))"
    ).alias("tile_geometry"))
    measures = {"area": geo.parts_area, "around": geo.parts_length}
    sizes = set()
    for cut in (cover.overlay_intersection(shapes, tiles, 0.05, measures=measures), cover.overlay_convex(shapes, slanted, 0.05, measures=measures)):
        again = cut.select(F.expr(geo.parts_area("geometry.parts")).alias("x"), F.expr(geo.parts_length("geometry.parts")).alias("y"), "area", "around").collect()
        assert all(r.x == r.area > 0 and r.y == r.around for r in again)
        assert len(again) > 100 and len(in_tasks(cut.select("a", "b"))) >= 4
        sizes |= {round(r.area, 9) for r in again}
    assert max(sizes) == 0.0004 > min(sizes)  # whole ones and cut ones


def test_a_shape_that_only_touches_a_convex_tile_has_no_piece(spark):
    # borders that share a coordinate to the last digit, far from the origin
    at = spark.range(300).selectExpr("id", "-74.01D + id * 7919 % 15000 / 100000D AS x", "40.75D + id * 6101 % 13000 / 100000D AS y")
    shapes = at.select("id", F.expr(geo.box_polygon("x - 0.0001D", "y", "x", "y + 0.0001D")).alias("geometry"))
    tile = geo.polygon([("x", "y - 0.003D"), ("x + 0.003D", "y + 0.001D"), ("x", "y + 0.0021D"), ("x", "y - 0.003D")])
    tiles = at.select(F.col("id").alias("tile"), "x", "y", F.expr(tile).alias("tile_geometry"))
    pieces = cover.overlay_convex(shapes, tiles)
    wrong = pieces.join(at.withColumnRenamed("x", "own").drop("y"), "id").where("own <= x")
    assert wrong.count() == 0


def test_bins_are_small_beside_the_larger_shape(spark):
    # as many envelopes as a bin of their own size would hold meet in twice the pairs that share a point, not nine times
    shapes, boxes = squares(spark, 600, "a", 0.0001, "geometry"), squares(spark, 600, "b", 0.006, "aoi")
    left, right = (cover._leveled(df, g, side, 0.0001) for df, g, side in ((shapes, "geometry", "l"), (boxes, "aoi", "r")))
    levels = [{r[0] for r in df.select(c).distinct().collect()} for df, c in ((left, "_ll"), (right, "_rl"))]
    assert all(0.006 / 4 <= 0.0001 * 2 ** k <= 0.006 / 2 for k in levels[1])
    small, large = cover._binned(left, "l", 0.0001, sorted(levels[1])), cover._binned(right, "r", 0.0001, sorted(levels[0]))
    assert {r[0] for r in small.select("_level").distinct().collect()} == levels[1]  # not at its own, where it meets none
    assert large.groupBy("b").count().agg(F.max("count")).first()[0] <= 25


def test_sides_beyond_the_written_ones_count(spark):
    corners = [(round(float(x), 9), round(float(y), 9)) for x, y in ((np.cos(a), np.sin(a)) for a in np.arange(9) * 2 * np.pi / 9)]
    boxes = spark.createDataFrame(
        [(x / 5, y / 5, x / 5 + 0.1, y / 5 + 0.1) for x in range(-7, 7) for y in range(-7, 7)], "x0 double, y0 double, x1 double, y1 double"
    )
    box = ("x0", "y0", "x1", "y1")
    for n in (3, 4, 9):
        ring = "array(" + ", ".join(geo.point(f"{x}D", f"{y}D") for x, y in [*corners[:n], corners[0]]) + ")"
        placed = boxes.withColumn("sides", F.expr(geo.half_planes(ring)))
        least, most = geo._least_and_most(box)
        wrong = placed.where(
            f"{geo.beyond_sides('sides', box)} <> exists(sides, s_ -> {most} <= 0) OR {geo.any_side_cuts('sides', box)} <> exists(sides, s_ -> {least} < 0)"
        )
        assert wrong.count() == 0
        assert 0 < placed.where(geo.beyond_sides("sides", box)).count() < placed.count()


# ---------------------------------------------------------------- pairs within blocks

def rough_polygons(n, seed, spread=12.0):
    """Polygons of one or two parts, some with a hole, some with crossing sides."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        parts = []
        for _ in range(1 + i % 2):
            x, y = map(float, rng.uniform(0, spread, 2))
            turn = np.sort(rng.uniform(0, 2 * np.pi, 3 + i % 6)) if i % 7 else rng.uniform(0, 2 * np.pi, 5)
            size = float(rng.uniform(0.2, 2.5))
            ring = [(float(x + size * np.cos(a)), float(y + size * np.sin(a))) for a in turn]
            hole = [(x + (u - x) * 0.3, y + (v - y) * 0.3) for u, v in ring[::-1]]
            parts.append([ring + ring[:1]] + ([hole + hole[:1]] if i % 3 == 0 else []))
        rows.append((i, ("Polygon", parts)))
    return rows


def convex_tiles(n, seed, spread=12.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        (x, y), size = rng.uniform(0, spread, 2), rng.uniform(0.3, 4)
        ring = [(float(x + size * np.cos(a)), float(y + size * np.sin(a))) for a in rng.uniform(0, 1) + np.arange(3 + i % 5) * 2 * np.pi / (3 + i % 5)]
        ring = ring if i % 2 else ring[::-1]
        rows.append((i // 3, ("Polygon", [[ring + ring[:1]]])))
    return rows


def test_pieces_and_measures_in_arrays_are_those_of_the_sql(spark):
    shapes = spark.createDataFrame(rough_polygons(60, 5), f"id int, geometry {geo.GEOMETRY_DDL}")
    tiles = spark.createDataFrame(convex_tiles(45, 6), f"tile int, tile_geometry {geo.GEOMETRY_DDL}").withColumn("k", F.monotonically_increasing_id())
    projected = lambda parts: geo.parts_area(geo.transform_parts(parts, crs.vertices_to_state_plane))
    measures = {"area": geo.parts_area, "feet": cover.Measure(projected, planar.state_plane_areas)}
    got = {(r.id, r.k): r for r in cover.overlay_convex(shapes, tiles, 1.0, measures=measures, columns=["id", "k", "geometry"]).collect()}
    cut = geo.clip_parts_to_sides("geometry.parts", geo.half_planes("tile_geometry.parts[0][0]"))
    want = shapes.crossJoin(tiles).withColumn("cut", F.expr(cut)).select(
        "id", "k", F.expr(geo.parts_area("cut")).alias("area"), F.expr(projected("cut")).alias("feet")
    ).where("area > 1e-12").collect()
    assert len(want) > 300 and {(r.id, r.k) for r in want} <= set(got)
    for r in want:
        assert got[r.id, r.k].area == pytest.approx(r.area, rel=1e-9, abs=1e-12) and got[r.id, r.k].feet == pytest.approx(r.feet, rel=1e-9)
    assert all(r.area <= 1e-9 for key, r in got.items() if key not in {(w.id, w.k) for w in want})


def test_sums_by_keys_need_no_shuffle_of_pairs(spark):
    shapes = spark.createDataFrame(rough_polygons(90, 8), f"id int, geometry {geo.GEOMETRY_DDL}")
    shapes = shapes.withColumn("id", F.expr("IF(id % 11 = 0, NULL, id div 2)"))  # keys that repeat, and NULLs
    tiles = spark.createDataFrame(convex_tiles(60, 9), f"tile int, tile_geometry {geo.GEOMETRY_DDL}")
    tiles = tiles.withColumn("tile", F.expr("IF(tile = 4, NULL, tile)"))
    pieces = cover.overlay_convex(shapes, tiles, 0.5, measures={"area": geo.parts_area})
    want = {(r.id, r.tile): r.area for r in pieces.groupBy("id", "tile").agg(F.sum("area").alias("area")).collect()}
    sums = cover.overlay_convex(shapes, tiles, 0.5, measures={"area": geo.parts_area}, by=("id", "tile"))
    got = {(r.id, r.tile): r.area for r in sums.collect()}
    assert len(got) == sums.count() == len(want) > 200 and {None} < {i for i, _ in got} and {None} < {t for _, t in got}
    assert all(got[key] == pytest.approx(area, rel=1e-9) for key, area in want.items())
    rounded = cover.overlay_convex(shapes, tiles, 0.5, measures={"area": geo.parts_area}, by=("id", "tile"), scaled=(100.0, 2))
    assert all(r.area == pytest.approx(got[r.id, r.tile] * 100, abs=0.0051) and round(r.area, 2) == r.area for r in rounded.collect())
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan.split("MapInArrow")[0]
    texts = cover.overlay_convex(shapes, tiles, 0.5, measures={"around": geo.parts_length}, by=("id", "tile"))
    long = {(r.id, r.tile): r.around for r in pieces.groupBy("id", "tile").agg(F.sum(F.expr(geo.parts_length("geometry.parts"))).alias("around")).collect()}
    assert {(r.id, r.tile): pytest.approx(r.around) for r in texts.collect()} == long


def test_a_shape_has_few_rows_among_boxes_of_all_sizes(spark, monkeypatch):
    shapes = squares(spark, 2000, "a", 0.0001, "geometry")
    sizes = [0.00002 * 2**k for k in range(9)] + [360.0]
    boxes = spark.createDataFrame(
        [(i, 0.3 + i / 500, 0.4 + i / 700, 0.3 + i / 500 + sizes[i % 10], 0.4 + i / 700 + sizes[i % 10]) for i in range(100)],
        "b long, x0 double, y0 double, x1 double, y1 double",
    ).select("b", F.expr(geo.box_polygon("x0", "y0", "x1", "y1")).alias("aoi"))

    def counting(kernel, keys, by):
        def run(batches):
            import pyarrow as pa
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"a": [batch.num_rows], "b": [0]}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        return run

    monkeypatch.setattr(cover.meeting, "worker", counting)
    rows = cover.aoi_join(shapes, boxes, cell=0.00001, columns=["a", "b"]).agg(F.sum("a")).first()[0]
    assert rows <= 9 * (2000 + 100)


def test_candidates_are_all_pairs_that_meet():
    rng = np.random.default_rng(4)

    def boxes(n, most):
        low = np.round(rng.uniform(0, 10, (2, n)), 2)
        high = low + np.round(rng.uniform(0, most, (2, n)), 2)
        return low[0], low[1], high[0], high[1]

    slot_i, slot_q = np.sort(rng.integers(0, 5, 700)), np.sort(rng.choice([0, 1, 3, 6], 160))
    own, other, group = boxes(700, 0.5), boxes(160, 3), rng.integers(0, 40, 160)
    group = group[np.lexsort((group, slot_q))]
    planes = planar.box_planes(other)
    want = {(i, q) for i in range(700) for q in range(160) if slot_i[i] == slot_q[q] and own[0][i] <= other[2][q] and own[2][i] >= other[0][q] and own[1][i] <= other[3][q] and own[3][i] >= other[1][q]}
    for inner, together, step in ((None, None, 1 << 17), (planes.inner, None, 100), (planes.inner, group, 50)):
        seen, steps, sure = [], {}, 0
        for n, (looked, known) in enumerate(planar.candidates(slot_i, own, slot_q, other, inner, together, step)):
            sure += len(known[0])
            for i, q in zip(*known):
                assert own[0][i] >= other[0][q] and own[1][i] >= other[1][q] and own[2][i] <= other[2][q] and own[3][i] <= other[3][q]
            for i, q in [*zip(*looked), *zip(*known)]:
                seen.append((int(i), int(q)))
                steps.setdefault((slot_q[q], group[q]), set()).add(n)
        assert len(seen) == len(set(seen)) and want <= set(seen) and len(seen) < 700 * 160 / 5
        assert (sure > 10) == (inner is not None)
        assert together is None or all(len(n) == 1 for n in steps.values())


def test_rounding_in_arrays_is_that_of_spark(spark):
    values = [0.005, 1.005, 2.675, -2.675, 0.125, 0.375, -0.375, 1e15 + 0.5, 123456.785, 3.0, 0.0, 1e-9, 2.5e300, *np.random.default_rng(2).uniform(-1e5, 1e5, 500).round(3)]
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double").select("i", F.round("v", 2).alias("v"))
    want = [r.v for r in frame.orderBy("i").collect()]
    assert planar.round_half_up(np.array(values, float), 2).tolist() == want
