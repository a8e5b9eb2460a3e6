"""Feature layers to bands: one cover join and one aggregation per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terraquilt.grid import GridSpec
from terraquilt.operators.cover import (
    EMPTY, cell_statistics, clip_area_sqft, cover_cells, on_grid, statistic,
)
from terraquilt.operators.labels import group_median_fill, label_encode
from terraquilt.session import small_table

# Category-count bands and the zone letter each one counts.
ZONE_COUNT_BANDS = {"has_residence": "R", "has_manufacture": "M", "has_commercial": "C", "has_park": "P"}


def rasterize_buildings(buildings: DataFrame, grid: GridSpec) -> DataFrame:
    """Mean height, height deviation, mean year and built area (sq ft) of every cell."""
    cover = cover_cells(buildings.select("heightroof", "cnstrct_yr", "geometry"), grid)
    return cell_statistics(cover, {
        "building_height": ("mean", F.col("heightroof")),
        "building_height_std": ("std_dev", F.col("heightroof")),
        "building_year": ("mean", F.col("cnstrct_yr")),
        "building_area": ("sum_area", clip_area_sqft(grid)),
    }, grid)


def prepare_streets(streets: DataFrame) -> DataFrame:
    """Category codes and group medians the street bands are made of."""
    columns = ["TrafDir", "direction", "RW_TYPE", "street_width_avg", "Number_Total_Lanes", "geometry"]
    encoded = label_encode(streets.select(*columns), ["TrafDir", "direction"])
    return group_median_fill(encoded, "RW_TYPE", ["street_width_avg", "Number_Total_Lanes"], medians_from=streets)


def rasterize_streets(streets: DataFrame, grid: GridSpec, highway: int = 2) -> DataFrame:
    """Width, traffic direction, lanes, orientation, type and highway presence of every cell."""
    cover = cover_cells(prepare_streets(streets), grid)
    return cell_statistics(cover, {
        "street_width": ("mean", F.col("street_width_avg")),
        "street_traffic": ("mode", F.col("TrafDir")),
        "street_lanes": ("mean", F.col("Number_Total_Lanes")),
        "street_orientation": ("mode", F.col("direction")),
        "street_type": ("mode", F.col("RW_TYPE")),
        "high_way": ("presence", F.when(F.col("RW_TYPE") == highway, 1)),
    }, grid)


def _modes(features: DataFrame, columns: list[str], grid: GridSpec) -> DataFrame:
    encoded = label_encode(features.select(*columns, "geometry"), columns)
    return cell_statistics(cover_cells(encoded, grid), {c: ("mode", F.col(c)) for c in columns}, grid)


def rasterize_overlays(overlays: DataFrame, grid: GridSpec) -> DataFrame:
    return _modes(overlays, ["overlay_level2", "overlay_level1"], grid)


def rasterize_special(districts: DataFrame, grid: GridSpec) -> DataFrame:
    return _modes(districts, ["sd_level1", "sd_level2"], grid)


def rasterize_zoning(zones: DataFrame, grid: GridSpec) -> DataFrame:
    """Dominant district at three levels and the number of zones of each kind per cell."""
    levels = ["zonedist_level1", "zonedist_level2", "zonedist_level3"]
    lettered = zones.select(*levels, "geometry", F.col("zonedist_level1").alias("_letter"))
    cover = cover_cells(label_encode(lettered, levels), grid)
    modes = [statistic("mode", F.col(c)).alias(c) for c in levels]
    counts = [F.count_if(F.col("_letter") == v).alias(name) for name, v in ZONE_COUNT_BANDS.items()]
    defaults = {c: EMPTY["mode"] for c in levels} | {name: 0 for name in ZONE_COUNT_BANDS}
    return on_grid(cover.groupBy("row", "col").agg(*modes, *counts), grid, defaults)


def bands_to_pixels(wide: DataFrame, raster_id: str, bands: list[str]) -> DataFrame:
    """Wide cell table to pixel rows; band numbers follow the given order."""
    entries = F.array(*[
        F.struct(
            F.lit(raster_id).alias("raster_id"), F.lit(i).alias("band"), F.col(b).cast("double").alias("value")
        )
        for i, b in enumerate(bands, start=1)
    ])
    return wide.select("row", "col", F.inline(entries)).select("raster_id", "band", "row", "col", "value")


def band_table(spark, raster_id: str, bands: list[str], suffix: str = "") -> DataFrame:
    """Names of a raster's bands, numbered from 1."""
    rows = [(raster_id, i, f"{b}{suffix}") for i, b in enumerate(bands, start=1)]
    return small_table(spark, rows, "raster_id string, band int, name string")
