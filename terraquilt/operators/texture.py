"""Grey-level co-occurrence texture in the clipped square around each pixel.

Pairs are ``(r, c)`` with ``(r + 1, c + 1)`` (distance 1, 45 degrees), symmetric and
normalised over 16 levels. Spark spreads the raster over halo tiles; inside a tile a
summed-area table per level pair gives every window's pair counts at a cost that does not
depend on the window size. The same counts as row operations would cost ``(2 * size) ** 2``
values per pixel, because the sum of squared counts is not separable.
"""

from __future__ import annotations

import sys
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from terraquilt.functions.maths import null_if_nan, quantise
from terraquilt.operators.tiling import TILE, TILE_KEYS, halo_tiles
from terraquilt.session import broadcast_if_small

# The kernel travels with the task, so workers need NumPy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Property names.
PROPERTIES = ("contrast", "dissimilarity", "homogeneity", "energy", "correlation", "ASM")
LEVELS = 16


def quantise_16(pixels: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Add ``level``: the value on 16 steps of its band's own range."""
    value = null_if_nan(F.col("value").cast("double"))
    ranges = pixels.groupBy("raster_id", "band").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return (
        pixels.join(broadcast_if_small(ranges), ["raster_id", "band"])
        .withColumn("level", quantise(value, F.col("_lo"), F.col("_hi"), levels))
        .drop("_lo", "_hi")
    )


def _box_sums(values: np.ndarray, side: int) -> np.ndarray:
    """Sums over all full ``side`` x ``side`` squares."""
    table = np.zeros((values.shape[0] + 1, values.shape[1] + 1), dtype=np.float64)
    np.cumsum(np.cumsum(values, axis=0), axis=1, out=table[1:, 1:])
    return table[side:, side:] - table[:-side, side:] - table[side:, :-side] + table[:-side, :-side]


def _tile_texture(level: np.ndarray, size: int, levels: int) -> dict[str, np.ndarray]:
    """Properties of the inner cells of one tile; ``level`` includes the halo, -1 is absent."""
    a, b = level[:-1, :-1].astype(np.int64), level[1:, 1:].astype(np.int64)
    known = (a >= 0) & (b >= 0)
    a, b = np.where(known, a, 0), np.where(known, b, 0)
    side = 2 * size

    def window(x):
        return _box_sums(np.where(known, x, 0), side)

    n = window(np.ones_like(a))
    pairs = np.maximum(n, 1)
    gap = np.abs(a - b)
    total, squares, product = window(a + b), window(a * a + b * b), window(a * b)
    spread = 2 * n * squares - total * total
    together = 4 * n * product - total * total
    code = np.where(known, np.minimum(a, b) * levels + np.maximum(a, b), -1)
    asm = np.zeros_like(n)
    for k in np.unique(code[known]):
        count = _box_sums(code == k, side)
        asm += count * count * (1.0 if k // levels == k % levels else 0.5)
    asm /= pairs * pairs
    return {
        "contrast": window(gap * gap) / pairs,
        "dissimilarity": window(gap) / pairs,
        "homogeneity": window(1.0 / (1 + gap * gap)) / pairs,
        "energy": np.sqrt(asm),
        "correlation": np.where(spread > 0.5, together / np.where(spread > 0.5, spread, 1), 1.0),
        "ASM": asm,
    }


def glcm_texture(pixels: DataFrame, size: int, levels: int = LEVELS, tile: int = TILE) -> DataFrame:
    """Add the six texture properties to a pixel table; missing pixels form no pairs."""
    if size < 1:
        raise ValueError("texture needs a window of at least 3x3")
    tiled = halo_tiles(
        quantise_16(pixels, levels).select("raster_id", "band", "row", "col", "level"), size, tile
    )
    extent = tile + 2 * size

    def texture(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        top, left = key[2] * tile - size, key[3] * tile - size
        r, c = rows["row"].to_numpy() - top, rows["col"].to_numpy() - left
        grid = np.full((extent, extent), -1, dtype=np.int16)
        grid[r, c] = rows["level"].fillna(-1).to_numpy()
        own = (r >= size) & (r < size + tile) & (c >= size) & (c < size + tile)
        out = rows.loc[own, ["raster_id", "band", "row", "col"]].copy()
        for name, values in _tile_texture(grid, size, levels).items():
            out[name] = values[r[own] - size, c[own] - size]
        return out

    schema = "raster_id string, band int, row int, col int, " + ", ".join(f"{p} double" for p in PROPERTIES)
    return tiled.groupBy(*TILE_KEYS).applyInPandas(texture, schema)
