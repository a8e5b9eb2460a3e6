"""Halo tiles: the unit of work of every neighbourhood operator.

Each pixel is copied to the square tiles whose neighbourhood reaches it (a copy factor
near ``(1 + 2 * reach / tile) ** 2``) and the table is hashed once on the tile. Any number
of window passes inside a tile then need no further shuffle, and no group is larger than
``(tile + 2 * reach) ** 2`` pixels whatever the shape of the raster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TILE = 256
TILE_KEYS = ["raster_id", "band", "tile_row", "tile_col"]


def _tiles_reaching(index: str, reach: int, tile: int) -> Column:
    first = F.expr(f"CAST(greatest({index} - {reach}, 0) div {tile} AS INT)")
    last = F.expr(f"CAST(({index} + {reach}) div {tile} AS INT)")
    return F.explode(F.sequence(first, last))


def halo_tiles(pixels: DataFrame, reach: int, tile: int = TILE) -> DataFrame:
    """Copy pixels to the tiles that need them and partition by tile."""
    return (
        pixels.withColumn("tile_row", _tiles_reaching("row", reach, tile))
        .withColumn("tile_col", _tiles_reaching("col", reach, tile))
        .repartition(*TILE_KEYS)
    )


def in_tile(index: str, tile_index: str, tile: int = TILE) -> Column:
    """The pixel belongs to the tile itself, not to its halo."""
    return F.expr(f"{index} div {tile}") == F.col(tile_index)
