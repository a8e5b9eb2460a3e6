"""Distance of every pixel to the nearest source, with steps of 1 and diagonal steps of sqrt(2).

The grid has no obstacles, so a shortest way is one straight run and one diagonal run.
The distance is therefore the source indicator swept along four line directions, each
sweep being ``min over p' of a(p') + step * |p - p'|``: a running minimum from either end.
No pair of pixel and source is ever formed. Lines are cut into blocks with a carried
minimum per block, so a line of any length never sits in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 4096
KEYS = ["raster_id", "band"]


def _sweep(
    cells: DataFrame, line: Column, pos: Column, row: Column, col: Column, step: float, block: int
) -> DataFrame:
    """One line direction. ``row``/``col`` rebuild the cell from ``_line`` and ``_pos``.

    Both uses of the partitioned table below read the same columns, so Spark runs its shuffle once and reuses it.
    """
    placed = cells.select(*KEYS, line.alias("_line"), pos.alias("_pos"), "a")
    group = [*KEYS, "_line", "_block"]
    block_of = F.coalesce(F.floor(F.col("_pos") / block).cast("int"), F.lit(0))
    placed = placed.withColumn("_block", block_of).repartition(*group)
    rising = F.col("a") - F.col("_pos") * F.lit(step)
    falling = F.col("a") + F.col("_pos") * F.lit(step)

    upto = Window.partitionBy(*group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    downto = Window.partitionBy(*group).orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, 0)
    swept = placed.withColumn("_r", F.min(rising).over(upto)).withColumn("_f", F.min(falling).over(downto))
    blocks = placed.groupBy(*group).agg(F.min(rising).alias("_br"), F.min(falling).alias("_bf"))
    along = Window.partitionBy(*KEYS, "_line")
    earlier = along.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    later = along.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*group, F.min("_br").over(earlier).alias("_cr"), F.min("_bf").over(later).alias("_cf"))
    swept = swept.join(carried, group).withColumns({"_r": F.least("_r", "_cr"), "_f": F.least("_f", "_cf")})
    nearest = F.least(F.col("_r") + F.col("_pos") * F.lit(step), F.col("_f") - F.col("_pos") * F.lit(step))
    return swept.select(*KEYS, row.cast("int").alias("row"), col.cast("int").alias("col"), nearest.alias("a"))


def distance_transform(pixels: DataFrame, block: int = BLOCK) -> DataFrame:
    """``distance`` from each cell to the nearest cell with value > 0; infinite if a band has none.

    ``pixels`` must hold every cell of the grid (NULL or 0 where there is no source). Rows
    without raster, band, row or column are no pixels and have no distance.
    """
    root2 = math.sqrt(2.0)
    # keys made non-null for the planner too, so no filter is derived on one use of the shuffle only
    cells = pixels.dropna(subset=[*KEYS, "row", "col"]).select(
        F.coalesce("raster_id", F.lit("")).alias("raster_id"),
        F.coalesce("band", F.lit(0)).alias("band"),
        F.coalesce("row", F.lit(0)).alias("row"),
        F.coalesce("col", F.lit(0)).alias("col"),
        F.when(F.col("value") > 0, F.lit(0.0)).otherwise(F.lit(math.inf)).alias("a"),
    )
    r, c, line, pos = F.col("row"), F.col("col"), F.col("_line"), F.col("_pos")
    cells = _sweep(cells, r - c, r, pos, pos - line, root2, block)
    cells = _sweep(cells, r + c, r, pos, line - pos, root2, block)
    cells = _sweep(cells, r, c, line, pos, 1.0, block)
    cells = _sweep(cells, c, r, pos, line, 1.0, block)
    return cells.withColumnRenamed("a", "distance")


def zoning_distance(pixels: DataFrame, band_meta: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Distance for every band given, renamed ``<band>_distance``."""
    distances = distance_transform(pixels, block).withColumnRenamed("distance", "value")
    return distances, band_meta.withColumn("name", F.concat("name", F.lit("_distance")))
