"""Reprojection of tile tables: source tiles travel to the target tiles whose footprint needs them."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from terraquilt.functions import crs
from terraquilt.grid import GridSpec
from terraquilt.session import broadcast_if_small

# The kernel travels with the task, so workers need NumPy and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE_KEYS = ["raster_id", "band", "_tr", "_tc"]


def _target_cells(spark, source: GridSpec, target: GridSpec, tile: int) -> DataFrame:
    """Every target cell whose centre lies in the source: its tile, and where it is there, in source pixels."""
    there = F.expr(crs.transform_xy(target.centre_x("col"), target.centre_y("row"), target.srid, source.srid))
    u, v = (F.col("_p.x") - F.lit(source.x0)) / F.lit(source.px), (F.lit(source.y1) - F.col("_p.y")) / F.lit(source.py)
    cells = target.cells(spark).withColumn("_p", there).select(
        F.expr(f"CAST(row div {tile} AS INT)").alias("_tr"), F.expr(f"CAST(col div {tile} AS INT)").alias("_tc"), "row", "col",
        u.alias("u"), v.alias("v"),
    )
    return cells.where((F.col("u") >= 0) & (F.col("u") < source.width) & (F.col("v") >= 0) & (F.col("v") < source.height))


def _footprints(cells: DataFrame, halo: int, tile_size: int) -> DataFrame:
    """Source tiles (tile_row, tile_col) that each target tile needs, ``halo`` pixels around its cells included."""
    def reach(name: str) -> list:
        return [
            F.floor(F.greatest(F.floor(F.min(name)) - halo, F.lit(0)) / tile_size).cast("int").alias(f"{name}0"),
            F.floor((F.floor(F.max(name)) + halo) / tile_size).cast("int").alias(f"{name}1"),
        ]

    spans = cells.groupBy("_tr", "_tc").agg(*reach("u"), *reach("v"))
    return spans.withColumn("tile_row", F.explode(F.sequence("v0", "v1"))).withColumn(
        "tile_col", F.explode(F.sequence("u0", "u1"))
    ).select("_tr", "_tc", "tile_row", "tile_col")


def resample(tiles: list[tuple[int, int, int, np.ndarray]], tile_size: int, u: np.ndarray, v: np.ndarray, method: str) -> np.ndarray:
    """Values at places in source pixels, from tiles (tile row, tile column, stride, data); NaN where there is none."""
    top, left = min(t[0] for t in tiles) * tile_size, min(t[1] for t in tiles) * tile_size
    bottom, right = (max(t[0] for t in tiles) + 1) * tile_size, (max(t[1] for t in tiles) + 1) * tile_size
    window = np.full((bottom - top, right - left), np.nan)
    for row, col, stride, data in tiles:
        # the last line of a tile may end at its last value
        block = np.concatenate([data, np.full(-len(data) % stride, np.nan)]).reshape(-1, stride)
        r, c = row * tile_size - top, col * tile_size - left
        window[r:r + len(block), c:c + stride] = block

    def at(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        r, c = r - top, c - left
        inside = (r >= 0) & (r < window.shape[0]) & (c >= 0) & (c < window.shape[1])
        return np.where(inside, window[np.where(inside, r, 0), np.where(inside, c, 0)], np.nan)

    if method == "nearest":
        return at(np.floor(v).astype(int), np.floor(u).astype(int))
    c, r = np.floor(u - 0.5).astype(int), np.floor(v - 0.5).astype(int)
    fx, fy = u - 0.5 - c, v - 0.5 - r
    total, weight = np.zeros(len(u)), np.zeros(len(u))
    for dr, wy in ((0, 1 - fy), (1, fy)):
        for dc, wx in ((0, 1 - fx), (1, fx)):
            value = at(r + dr, c + dc)
            w = np.where(np.isnan(value), 0.0, wy * wx)
            total += np.where(w > 0, value, 0.0) * w
            weight += w
    return np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), np.nan)


def warp_tiles(
    tiles: DataFrame, tile_size: int, source: GridSpec, target: GridSpec, method: str = "nearest", tile: int = 64
) -> DataFrame:
    """Reproject a tile table to a pixel table on the target grid: the values of ``reproject`` without a row per source pixel.

    Target tiles' footprints say which source tiles they need, a pixel more around for neighbours that are
    weighed. Each source tile is shuffled once to each of the few target tiles that need it, and resampled there with
    NumPy. NULL and NaN pixels are absent, as are cells without value. Rasters and bands are job parameters here: a few rows.
    """
    if method not in ("nearest", "bilinear"):
        raise ValueError("method is 'nearest' or 'bilinear'")
    spark = tiles.sparkSession
    cells = _target_cells(spark, source, target, tile)
    needed = broadcast_if_small(_footprints(cells, int(method == "bilinear"), tile_size))
    sent = tiles.join(needed, ["tile_row", "tile_col"]).select(*TILE_KEYS, "tile_row", "tile_col", "tile_w", "data")
    layers = tiles.select("raster_id", "band").distinct().collect()
    if not layers:
        return tiles.selectExpr("raster_id", "band", "tile_row AS row", "tile_col AS col", "CAST(NULL AS DOUBLE) AS value").where(F.lit(False))
    each = F.array(*[F.struct(F.lit(r["raster_id"]).alias("raster_id"), F.lit(r["band"]).alias("band")) for r in layers])
    wanted = cells.groupBy("_tr", "_tc").agg(
        *[F.collect_list(c).alias(c) for c in ("row", "col", "u", "v")]  # a tile's cells, in one order
    ).select("*", F.inline(each))

    def warp(places: pa.Table, found: pa.Table) -> pa.Table:
        empty = not len(places) or not len(found)
        if empty:
            none = pa.array([], pa.int32())
            return pa.table({"raster_id": pa.array([], pa.string()), "band": none, "row": none, "col": none, "value": pa.array([], pa.float64())})
        row, col, u, v = (places.column(c).combine_chunks().flatten() for c in ("row", "col", "u", "v"))
        parts = [
            (r, c, w, np.array([np.nan if x is None else x for x in data], float))
            for r, c, w, data in zip(*(found.column(c).to_pylist() for c in ("tile_row", "tile_col", "tile_w", "data")))
        ]
        values = resample(parts, tile_size, u.to_numpy(), v.to_numpy(), method)
        known = np.flatnonzero(~np.isnan(values))
        at, first = pa.array(known), pa.array(np.zeros(len(known), np.int64))
        return pa.table({
            "raster_id": places.column("raster_id").combine_chunks().take(first), "band": places.column("band").combine_chunks().take(first),
            "row": row.take(at), "col": col.take(at), "value": pa.array(values[known]),
        })

    return wanted.groupBy(*TILE_KEYS).cogroup(sent.groupBy(*TILE_KEYS)).applyInArrow(
        warp, "raster_id string, band int, row int, col int, value double"
    )
