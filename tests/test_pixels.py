"""Pixel operators against brute force on small grids."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import pixel_table
from terraquilt.functions.indices import BAND_MAPS, INDEX_NAMES
from terraquilt.grid import GridSpec
from terraquilt.operators import distance, focal, quantiles, raster, texture
from terraquilt.sources import readers, writers


def around(array, i, j, size):
    return array[max(i - size, 0): i + size + 1, max(j - size, 0): j + size + 1]


def focal_expected(array, size):
    out = {}
    for i, j in np.ndindex(array.shape):
        values = around(array, i, j, size)
        values = values[~np.isnan(values)]
        out[i, j] = (values.mean(), values.std(), np.median(values)) if len(values) else None
    return out


@pytest.mark.parametrize("size", [0, 1, 3])
@pytest.mark.parametrize("form", ["dense", "nan rows", "absent rows"])
def test_focal_matches_brute_force(spark, size, form):
    rng = np.random.default_rng(size)
    grid = rng.normal(2000, 5, (23, 31))
    if form != "dense":
        grid[rng.random(grid.shape) < 0.3] = np.nan
        grid[4:9, 10:20] = np.nan
    pixels = pixel_table(spark, grid, keep_nan=form != "absent rows")
    got = focal.focal_statistics(
        pixels, size, ("mean", "std_dev", "median"), tile=8, dense=form != "absent rows"
    ).collect()
    expected = focal_expected(grid, size)
    assert len(got) == (np.isfinite(grid).sum() if form == "absent rows" else grid.size)
    for r in got:
        want = expected[r.row, r.col]
        if want is None:
            assert r["mean"] is None and r.std_dev is None and r.median is None
        else:
            assert (r["mean"], r.std_dev, r.median) == pytest.approx(want, abs=1e-8)


def test_focal_rejects_unknown_operation(spark):
    with pytest.raises(ValueError, match="unknown focal operation"):
        focal.focal_statistics(pixel_table(spark, np.zeros((2, 2))), 1, ("mode",))


def glcm_expected(level, size):
    """Co-occurrence matrix of each window, pair by pair."""
    out = {}
    for i, j in np.ndindex(level.shape):
        window = around(level, i, j, size)
        p = np.zeros((16, 16))
        for r in range(window.shape[0] - 1):
            for c in range(window.shape[1] - 1):
                a, b = window[r, c], window[r + 1, c + 1]
                if a >= 0 and b >= 0:
                    p[a, b] += 1
                    p[b, a] += 1
        p /= max(p.sum(), 1)
        a, b = np.indices(p.shape)
        mu = (p * a).sum()
        var = (p * (a - mu) ** 2).sum()
        out[i, j] = (
            (p * (a - b) ** 2).sum(),
            (p * abs(a - b)).sum(),
            (p / (1 + (a - b) ** 2)).sum(),
            math.sqrt((p**2).sum()),
            (p * (a - mu) * (b - mu)).sum() / var if var > 1e-12 else 1.0,
            (p**2).sum(),
        )
    return out


@pytest.mark.parametrize("size", [1, 2, 5])
@pytest.mark.parametrize("holes", [False, True])
def test_texture_matches_matrix(spark, size, holes):
    rng = np.random.default_rng(7)
    grid = rng.integers(0, 5, (13, 18)).astype(float)
    grid[0:6, 0:6] = 3.0
    if holes:
        grid[rng.random(grid.shape) < 0.2] = np.nan
    low, high = np.nanmin(grid), np.nanmax(grid)
    level = np.where(np.isnan(grid), -1, np.floor((np.nan_to_num(grid) - low) / (high - low + 1) * 16)).astype(int)
    got = texture.glcm_texture(pixel_table(spark, grid, keep_nan=False), size, tile=6).collect()
    expected = glcm_expected(level, size)
    assert len(got) == np.isfinite(grid).sum()
    for r in got:
        assert tuple(r[p] for p in texture.PROPERTIES) == pytest.approx(expected[r.row, r.col], abs=1e-9)
        assert r.ASM == pytest.approx(r.energy**2)


@pytest.mark.parametrize("block", [4096, 5])
def test_distance_matches_all_sources(spark, block):
    rng = np.random.default_rng(3)
    grid = (rng.random((20, 33)) < 0.02).astype(float)
    sources = np.argwhere(grid > 0)
    got = distance.distance_transform(pixel_table(spark, grid), block).collect()
    assert len(got) == grid.size
    for r in got:
        gaps = np.abs(sources - (r.row, r.col))
        best = (gaps.max(axis=1) + (math.sqrt(2) - 1) * gaps.min(axis=1)).min()
        assert r.distance == pytest.approx(best, abs=1e-9)
        assert (r.distance == 0) == (grid[r.row, r.col] > 0)


def test_distance_ignores_pixels_without_key(spark):
    pixels = pixel_table(spark, np.zeros((2, 3)))
    stray = spark.createDataFrame([("r", 1, None, 0, 5.0), (None, 1, 0, 0, 5.0)], pixels.schema)
    got = distance.distance_transform(pixels.unionByName(stray)).collect()
    assert len(got) == 6 and {r.distance for r in got} == {math.inf}


def test_distance_without_source_is_infinite(spark):
    got = distance.distance_transform(pixel_table(spark, np.zeros((4, 3)))).collect()
    assert {r.distance for r in got} == {math.inf}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_distance_shuffles_once_per_sweep(spark):
    pixels = pixel_table(spark, np.eye(6))
    blocked = final_plan(distance.distance_transform(pixels))
    assert blocked.count("ReusedExchange") == 4 and blocked.count("REPARTITION_BY_COL") == 8


def test_focal_needs_one_shuffle(spark):
    plan = final_plan(focal.focal_statistics(pixel_table(spark, np.eye(6)), 1, ("mean", "std_dev")))
    assert plan.count("Exchange hashpartitioning") == 1
    plan = final_plan(focal.focal_statistics(pixel_table(spark, np.eye(6)), 1, ("median",)))
    assert plan.count("Exchange hashpartitioning") == 1


def test_octile_known_answer(spark):
    grid = np.zeros((4, 6))
    grid[0, 0] = 1
    got = {(r.row, r.col): r.distance for r in distance.distance_transform(pixel_table(spark, grid)).collect()}
    assert got[3, 5] == pytest.approx(6.2426406871)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_exact_percentiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    rows = [(k, float(v)) for k in ("a", "b", None) for v in np.round(rng.exponential(50, n), 1)]
    df = spark.createDataFrame(rows + [("empty", None), ("a", math.nan)], "k string, v double")
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p995": 0.995}
    got = {r.k: r for r in quantiles.exact_percentiles(df, ["k"], "v", probs).collect()}
    assert set(got) == {"a", "b", None, "empty"}
    assert all(got["empty"][p] is None for p in probs)
    for key in ("a", "b", None):
        values = [v for k, v in rows if k == key]
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.percentile(values, p * 100), abs=1e-9)


def test_exact_percentiles_beyond_the_sketch(spark):
    """More rows than the sketch keeps exactly, one value holding a third of them."""
    df = spark.range(300_000).select(
        F.lit(1).alias("k"), F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 299993) / 10).alias("v")
    )
    values = df.select("v").toPandas()["v"]
    got = quantiles.exact_percentiles(df, ["k"], "v", {"a": 0.05, "b": 0.34, "c": 0.95, "d": 0.995}).first()
    for name, p in {"a": 5, "b": 34, "c": 95, "d": 99.5}.items():
        assert got[name] == pytest.approx(np.percentile(values, p), abs=1e-9)


def test_tiles_round_trip_with_gaps(spark):
    rng = np.random.default_rng(1)
    grid = rng.random((37, 21))
    grid[rng.random(grid.shape) < 0.4] = np.nan
    pixels = pixel_table(spark, grid, keep_nan=False)
    back = readers.tiles_to_pixels(writers.pixels_to_tiles(pixels, 8), 8)
    assert {tuple(r) for r in back.select(*pixels.columns).collect()} == {tuple(r) for r in pixels.collect()}


@pytest.mark.parametrize("block", [1, 4, 5])
def test_canopy_count_matches_sliding_window(spark, block):
    """Zero-padded box sum centred on the pixel, sampled at every block-th row and column."""
    rng = np.random.default_rng(block)
    grid = (rng.random((17, 22)) < 0.5).astype(float)
    padded = np.pad(grid, block)
    expected = {}
    for i in range(0, grid.shape[0], block):
        for j in range(0, grid.shape[1], block):
            top, left = i - block // 2 + block, j - block // 2 + block
            expected[i // block, j // block] = int(padded[top: top + block, left: left + block].sum())
    pixels = pixel_table(spark, grid)
    got = raster.resample_canopy(pixels, raster.raster_extents(pixels), block).collect()
    assert {(r.row, r.col): r["count"] for r in got} == expected


def test_canopy_block_sizes():
    assert raster.canopy_block(30, 0.00001) == 27
    assert raster.canopy_block(5, 0.001) == 1


def test_block_mean_keeps_the_total(spark):
    grid = np.arange(35, dtype=float).reshape(5, 7)
    pixels = pixel_table(spark, grid)
    sizes = raster.raster_extents(pixels).select("*", F.lit(2).alias("out_height"), F.lit(3).alias("out_width"))
    got = raster.block_mean(pixels, sizes).collect()
    assert len(got) == 6
    assert np.mean([r.value for r in got]) == pytest.approx(grid.mean())


def test_height_width_ratio_missing_policy(spark):
    built = spark.createDataFrame([(0, 0, 30.0, 100.0), (0, 1, 30.0, 0.0)], "row int, col int, building_height double, building_area double")
    roads = spark.createDataFrame([(0, 0, 60.0), (0, 1, 0.0)], "row int, col int, street_width double")
    ratios = {r.col: r["var"] for r in raster.height_width_ratio(built, roads, 30).collect()}
    assert ratios == {0: 0.5, 1: -1.0}
    kept = {r.col: r["var"] for r in raster.height_width_ratio(built, roads, 30, missing=None).collect()}
    assert kept == {0: 0.5, 1: None}


def test_histogram_last_bin_is_closed_and_outside_counts(spark):
    pixels = pixel_table(spark, np.array([[0.0, 38.5, 39.0, 39.5, -1.0]]))
    got = {r.bin: r.fraction for r in raster.raster_histogram(pixels).collect()}
    assert got == {0: 0.2, 38: 0.4}


def test_clip_window_uses_pixel_centres():
    grid = GridSpec(0.0, 10.0, 1.0, 1.0, 10, 10)
    rows, cols, cropped = raster.clip_window(grid, (2.5, 3.6, 5.4, 7.0))
    assert (rows, cols) == ((3, 6), (2, 5))
    assert cropped.bbox == (2.0, 4.0, 5.0, 7.0)


def test_neighbourhood_texture_only_for_known_layers(spark):
    grid = np.arange(16, dtype=float).reshape(4, 4)
    pixels = pixel_table(spark, grid, "population_res1000").unionByName(pixel_table(spark, grid, "nyzd_res30"))
    names = spark.createDataFrame(
        [("population_res1000", 1, "pop"), ("nyzd_res30", 1, "zone")], "raster_id string, band int, name string"
    )
    got = {r.name for r in focal.neighbourhood_features(pixels, names, 1, tile=4).select("name").distinct().collect()}
    assert got == {"pop_mean_3x3", "pop_std_dev_3x3", "zone_mean_3x3", "zone_std_dev_3x3"} | {
        f"pop_{p}_3x3" for p in texture.PROPERTIES
    }


def test_points_without_coordinates_have_no_cell(spark):
    from terraquilt.grid import GridSpec
    from terraquilt.operators.sampling import point_cells

    nan = float("nan")
    points = spark.createDataFrame(
        [(0, 0.5, 9.5), (1, None, 9.5), (2, 0.5, None), (3, nan, 9.5), (4, 0.5, nan), (5, 99.0, -99.0)],
        "point_id int, lon double, lat double",
    )
    got = {r.point_id: (r.row, r.col) for r in point_cells(points, {"r": GridSpec(0.0, 10.0, 1.0, 1.0, 10, 10)}).collect()}
    assert got == {0: (0, 0), 5: (9, 9)}


def test_clip_in_feet_keeps_the_whole_box(spark):
    from terraquilt.grid import GridSpec
    from terraquilt.operators.raster import clip_bbox, outline_envelope

    box = (-74.01, 40.75, -73.86, 40.88)
    corner = outline_envelope((-73.86, 40.75, -73.86, 40.75), 4326, 2263)
    x0, y0, x1, y1 = outline_envelope(box, 4326, 2263)
    assert x1 >= corner[2] - 1e-6 and y0 <= corner[1] + 1e-6
    step, width, height = 15.0, 50, 50  # the north-east corner, where the box narrows by 76 feet
    grid = GridSpec(x1 - 600.0, y1 + 150.0, step, step, width, height, 2263)
    pixels = spark.range(height * width).selectExpr(
        "'r' AS raster_id", "1 AS band", f"CAST(id div {width} AS INT) AS row", f"CAST(id % {width} AS INT) AS col", "1.0D AS value"
    )
    clipped, window = clip_bbox(pixels, grid, box)
    values = {(r.row, r.col): r.value for r in clipped.collect()}
    assert len(values) == window.width * window.height
    assert 0 < sum(v is None for v in values.values()) < len(values) / 2


# ---------------------------------------------------------------- indices of sensors

def test_indices_of_odd_pixels_are_those_of_each_pixel(spark):
    """NULL keys and bands, NaN, missing bands, other bands and bands that come twice, whose larger value counts."""
    nan, numbers = float("nan"), BAND_MAPS["sentinel_2"]
    rows = [("a", b, 0, 0, float(b)) for b in numbers.values()] + [(None, b, None, 1, 0.5) for b in numbers.values()]
    rows += [("a", b, 0, 2, 0.0) for b in numbers.values()] + [("a", b, 0, 3, nan) for b in numbers.values()]
    rows += [("a", numbers["red"], 0, 0, 9.0), ("a", numbers["red"], 0, 0, None), ("a", None, 0, 0, 99.0), ("a", 7, 0, 4, 1.0)]
    rows += [("a", numbers["nir"], 1, 0, 3.0), ("a", numbers["red"], 1, 0, None)]
    pixels = spark.createDataFrame(rows, "raster_id string, band int, row int, col int, value double")
    columns = [F.max(F.when(F.col("band") == b, F.col("value"))).alias(n) for n, b in numbers.items()]
    wide = pixels.where(F.col("band").isin(*numbers.values())).groupBy("raster_id", "row", "col").agg(*columns)
    each = {tuple(r[:3]): r[3:] for r in raster.index_bands(wide).collect()}
    long = raster.sensor_indices(pixels, "sentinel_2")
    found = {(r.raster_id, r.row, r.col, r.band): r.value for r in long.collect()}
    assert len(each) == 5 and len(found) == 5 * len(INDEX_NAMES) == long.count()
    for key, values in each.items():
        assert [repr(found[(*key, i)]) for i in range(1, len(INDEX_NAMES) + 1)] == [repr(v) for v in values]
    again = raster.bands_to_columns(long, dict(enumerate(INDEX_NAMES, start=1)))
    assert {tuple(r[:3]): repr(r[3:]) for r in again.collect()} == {k: repr(v) for k, v in each.items()}


def test_generated_code_of_indices_is_small_enough_to_compile(spark, capsys):
    """The JVM interprets methods of more than 8,000 bytes."""
    pixels = pixel_table(spark, np.ones((2, 2)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else no code is known before the run
    try:
        raster.bands_to_columns(raster.sensor_indices(pixels, "landsat_8"), dict(enumerate(INDEX_NAMES, start=1))).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
