"""Point sampling and the assembled feature matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terraquilt.grid import GridSpec
from terraquilt.operators.skew import salted_join

KERNEL_OPERATIONS = ("mean", "std_dev")


def point_cells(points: DataFrame, grids: dict[str, GridSpec], point_id: str = "point_id") -> DataFrame:
    """Cell of every raster that holds each point; points outside snap to the edge pixel.

    Points without both coordinates (NULL or NaN) have no cell. The grids are job parameters,
    so this is a projection: no join with a table of rasters.
    """
    # clamping skips NULL and orders NaN last, so such points must go first
    placed = points.where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    cells = F.array(*[
        F.struct(
            F.lit(raster_id).alias("raster_id"),
            F.expr(f"greatest(0, least({g.height - 1}, {g.row_of('lat')}))").alias("row"),
            F.expr(f"greatest(0, least({g.width - 1}, {g.col_of('lon')}))").alias("col"),
        )
        for raster_id, g in grids.items()
    ])
    return placed.select(point_id, F.inline(cells))


def sample_long(
    points: DataFrame, pixels: DataFrame, band_meta: DataFrame, grids: dict[str, GridSpec], point_id: str = "point_id"
) -> DataFrame:
    """Value of every band of every raster at every point: ``(point_id, feature, value)``.

    Points outside a raster all snap to its edge, so its corner cells may hold any share of them: heavy cells are dealt out.
    """
    hits = salted_join(point_cells(points, grids, point_id), pixels, ["raster_id", "row", "col"])
    return hits.join(band_meta, ["raster_id", "band"]).select(point_id, F.col("name").alias("feature"), "value")


def assemble_matrix(samples: DataFrame, features: list[str], point_id: str = "point_id") -> DataFrame:
    """Long samples to one row per point with the named features in the given order."""
    return samples.groupBy(point_id).pivot("feature", features).agg(F.max("value")).select(point_id, *features)


def sample_points(
    points: DataFrame,
    pixels: DataFrame,
    band_meta: DataFrame,
    grids: dict[str, GridSpec],
    features: list[str],
    point_id: str = "point_id",
) -> DataFrame:
    """Points with one column per feature, all rasters in one job."""
    matrix = assemble_matrix(sample_long(points, pixels, band_meta, grids, point_id), features, point_id)
    return points.select(point_id, F.col("lat"), F.col("lon").alias("long")).join(matrix, point_id, "left")


def feature_names(
    bands: list[str], sizes: tuple[int, ...] = (), operations: tuple[str, ...] = KERNEL_OPERATIONS
) -> list[str]:
    """Column names ``<band>[_<operation>_<k>x<k>]`` of a feature matrix, sorted."""
    derived = [f"{b}_{op}_{2 * s + 1}x{2 * s + 1}" for b in bands for op in operations for s in sizes]
    return sorted([*bands, *derived])
