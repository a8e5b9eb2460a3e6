"""Neighbourhood statistics over the clipped square ``(2 * size + 1)`` wide around each pixel."""

from __future__ import annotations

import sys
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from terraquilt.config import TEXTURE_PREFIXES
from terraquilt.functions.maths import null_if_nan
from terraquilt.operators.tiling import TILE, TILE_KEYS, halo_tiles, in_tile

# The kernel travels with the task, so workers need NumPy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPERATIONS = ("mean", "std_dev", "median")
#: Side of the tiles that medians are taken in: a tile's counters are its lines times its distinct values.
MEDIAN_TILE = 64


def focal_name(band: str, operation: str, size: int) -> str:
    side = 2 * size + 1
    return f"{band}_{operation}_{side}x{side}"


def _fill_row_gaps(tiled: DataFrame, size: int, tile: int) -> DataFrame:
    """Add the absent cells of a tile line that lie within reach of a present one.

    The row pass has to leave a partial sum at every column a later column pass reads,
    also where the pixel itself is missing. Only columns of the tile proper are read.
    """
    line = Window.partitionBy(*TILE_KEYS, "row").orderBy("col")
    c, size_ = F.col("col"), F.lit(size)
    first = F.col("tile_col") * tile
    final = first + tile - 1
    before = F.coalesce(F.lag("col").over(line) + size_ + 1, first)
    after = F.coalesce(F.lead("col").over(line) - 1, final)
    spans = tiled.withColumn("_from", F.greatest(c - size_, before, first)).withColumn(
        "_to", F.least(c + size_, after, final)
    )
    # a halo pixel keeps its own place even though it is outside the span it fills
    spans = spans.withColumn("_from", F.least("_from", c)).withColumn("_to", F.greatest("_to", c))
    return (
        spans.withColumn("_c", F.explode(F.sequence("_from", "_to")))
        .withColumn("value", F.when(F.col("_c") == c, F.col("value")))
        .withColumn("_present", F.col("_c") == c)
        .withColumn("col", F.col("_c"))
        .drop("_from", "_to", "_c")
    )


def window_medians(grid: np.ndarray, size: int) -> np.ndarray:
    """Medians of all full squares ``2 * size + 1`` wide, NaN left out; NaN where nothing is left.

    Values are ranked once. Each line keeps a count for every rank, and one for every run of ranks about as
    many as the square root of their number, while its window moves along: a step adds one column and
    takes one away, and a median is found among the runs and then inside one. So neither time nor memory of
    a step grows with the area of the window.
    """
    side = 2 * size + 1
    height, width = grid.shape[0] - 2 * size, grid.shape[1] - 2 * size
    known = ~np.isnan(grid)
    out = np.full((height, width), np.nan)
    if not known.any():
        return out
    values, found = np.unique(grid[known], return_inverse=True)
    ranks = np.full(grid.shape, -1, np.int64)
    ranks[known] = found
    fine = 1 << max(1, (len(values) - 1).bit_length() // 2)
    coarse = -(-len(values) // fine)
    counts, runs = np.zeros(height * coarse * fine, np.int32), np.zeros(height * coarse, np.int32)
    total = np.zeros(height, np.int64)
    lines = np.arange(height)

    def turn(column: int, by: int) -> None:
        windows = np.lib.stride_tricks.sliding_window_view(ranks[:, column], side)
        line, place = np.nonzero(windows >= 0)
        rank = windows[line, place]
        np.add.at(counts, line * (coarse * fine) + rank, by)
        np.add.at(runs, line * coarse + rank // fine, by)
        np.add.at(total, line, by)

    def ranked(k: np.ndarray) -> np.ndarray:
        """The value of rank k in each line's window."""
        sums = np.cumsum(runs.reshape(height, coarse), axis=1)
        run = np.minimum((sums <= k[:, None]).sum(axis=1), coarse - 1)
        left = k - np.where(run > 0, sums[lines, run - 1], 0)
        inner = np.cumsum(counts.reshape(height, coarse, fine)[lines, run], axis=1)
        place = (inner <= left[:, None]).sum(axis=1)
        return values[np.minimum(run * fine + place, len(values) - 1)]

    for column in range(2 * size):
        turn(column, 1)
    for column in range(width):
        turn(column + 2 * size, 1)
        low = ranked(np.maximum(total - 1, 0) // 2)
        even = (total % 2 == 0) & (total > 0)
        high = ranked(total // 2) if even.any() else low
        out[:, column] = np.where(total > 0, np.where(even, (low + high) / 2, low), np.nan)
        turn(column, -1)
    return out


def focal_median(pixels: DataFrame, size: int, tile: int = MEDIAN_TILE) -> DataFrame:
    """Add ``median`` to a pixel table: exact, for windows of any width, one shuffle of halo tiles.

    NULL and NaN are left out; a neighbourhood without values gives NULL.
    """
    narrow = pixels.select("raster_id", "band", "row", "col", null_if_nan(F.col("value").cast("double")).alias("value"))
    extent = tile + 2 * size

    def medians(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        top, left = key[2] * tile - size, key[3] * tile - size
        r, c = rows["row"].to_numpy() - top, rows["col"].to_numpy() - left
        grid = np.full((extent, extent), np.nan)
        grid[r, c] = rows["value"].to_numpy(float, na_value=np.nan)
        own = (r >= size) & (r < size + tile) & (c >= size) & (c < size + tile)
        out = rows.loc[own, ["raster_id", "band", "row", "col", "value"]].copy()
        out["median"] = window_medians(grid, size)[r[own] - size, c[own] - size] if own.any() else np.zeros(0)
        return out

    schema = "raster_id string, band int, row int, col int, value double, median double"
    found = halo_tiles(narrow, size, tile).groupBy(*TILE_KEYS).applyInPandas(medians, schema)
    return found.withColumns({c: null_if_nan(F.col(c)) for c in ("value", "median")})


def focal_statistics(
    pixels: DataFrame,
    size: int,
    operations: tuple[str, ...] = ("mean", "std_dev"),
    tile: int = TILE,
    dense: bool = False,
) -> DataFrame:
    """Add one column per operation to a pixel table ``(raster_id, band, row, col, value)``.

    NULL and NaN are left out of every statistic; a neighbourhood without values gives
    NULL. Pass ``dense=True`` when every cell of every raster has a row, which saves
    the gap filling. One shuffle in all, whatever the number of operations, and one more for medians.
    """
    unknown = set(operations) - set(OPERATIONS)
    if unknown:
        raise ValueError(f"unknown focal operation: {sorted(unknown)}; known: {OPERATIONS}")
    if "median" in operations:
        medians = focal_median(pixels, size)
        others = tuple(op for op in operations if op != "median")
        if others:
            keys = ["raster_id", "band", "row", "col"]
            medians = focal_statistics(pixels, size, others, tile, dense).join(medians.drop("value"), keys)
        return medians.select("raster_id", "band", "row", "col", "value", *operations)
    narrow = pixels.select(
        "raster_id", "band", "row", "col", null_if_nan(F.col("value").cast("double")).alias("value")
    )
    tiled = halo_tiles(narrow, size, tile)
    # sums are taken around the tile's mean, so squares do not cancel
    tiled = tiled.withColumn("_base", F.avg("value").over(Window.partitionBy(*TILE_KEYS)))
    if dense:
        tiled = tiled.withColumn("_present", F.lit(True))
    else:
        tiled = _fill_row_gaps(tiled, size, tile)

    along_row = Window.partitionBy(*TILE_KEYS, "row").orderBy("col").rangeBetween(-size, size)
    along_col = Window.partitionBy(*TILE_KEYS, "col").orderBy("row").rangeBetween(-size, size)
    shifted = F.col("value") - F.col("_base")
    row_pass = {"_n": F.count("value").over(along_row), "_s": F.sum(shifted).over(along_row)}
    if "std_dev" in operations:
        row_pass["_ss"] = F.sum(shifted * shifted).over(along_row)
    rows = tiled.withColumns(row_pass).where(in_tile("col", "tile_col", tile))

    col_pass = {"_n": F.sum("_n").over(along_col), "_s": F.sum("_s").over(along_col)}
    if "std_dev" in operations:
        col_pass["_ss"] = F.sum("_ss").over(along_col)
    both = rows.withColumns(col_pass).where(in_tile("row", "tile_row", tile) & F.col("_present"))

    n = F.col("_n")
    offset = F.try_divide(F.col("_s"), n)
    results = {}
    if "mean" in operations:
        results["mean"] = F.col("_base") + offset
    if "std_dev" in operations:
        variance = F.col("_ss") / n - offset * offset
        results["std_dev"] = F.when(n > 0, F.sqrt(F.greatest(variance, F.lit(0.0))))
    return both.select(
        "raster_id", "band", "row", "col", "value", *[results[op].alias(op) for op in operations]
    )


def focal_bands(
    pixels: DataFrame, band_meta: DataFrame, operation: str, size: int, tile: int = TILE, dense: bool = False
) -> tuple[DataFrame, DataFrame]:
    """One operation on every band; returns the new pixels and their renamed band table."""
    smoothed = focal_statistics(pixels, size, (operation,), tile, dense).select(
        "raster_id", "band", "row", "col", F.col(operation).alias("value")
    )
    side = f"_{operation}_{2 * size + 1}x{2 * size + 1}"
    return smoothed, band_meta.withColumn("name", F.concat("name", F.lit(side)))


def wants_texture(raster_id, prefixes: tuple[str, ...] = TEXTURE_PREFIXES):
    """Texture is computed for layers whose name starts with a known prefix."""
    return raster_id.rlike("^(" + "|".join(prefixes) + ")")


def neighbourhood_features(
    pixels: DataFrame, band_meta: DataFrame, size: int, tile: int = TILE, dense: bool = False
) -> DataFrame:
    """Mean and deviation of every band of every raster, and texture where the name asks for it.

    One long table ``(raster_id, name, row, col, value)`` for all rasters together.
    """
    from terraquilt.operators.texture import PROPERTIES, glcm_texture

    operations = ("mean", "std_dev")
    stats = focal_statistics(pixels, size, operations, tile, dense)
    texture = glcm_texture(pixels.where(wants_texture(F.col("raster_id"))), size, tile=tile)

    def long(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(c).alias("op"), F.col(c).alias("v")) for c in columns])
        return df.select("raster_id", "band", "row", "col", F.inline(entries))

    side = f"_{2 * size + 1}x{2 * size + 1}"
    return (
        long(stats, operations)
        .unionByName(long(texture, PROPERTIES))
        .join(band_meta, ["raster_id", "band"])
        .select(
            "raster_id",
            F.concat("name", F.lit("_"), "op", F.lit(side)).alias("name"),
            "row",
            "col",
            F.col("v").alias("value"),
        )
    )
