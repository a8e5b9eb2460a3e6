"""Output tables: Parquet, CSV, GeoJSON lines, raster tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terraquilt.functions import geometry as geo


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def to_feature_lines(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature per row, as text; all other columns become properties."""
    properties = F.struct(*[F.col(c) for c in df.columns if c != geometry])
    shape = F.coalesce(F.expr(geo.geometry_to_geojson(geometry)), F.lit("null"))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'),
            F.to_json(properties, {"ignoreNullFields": "false"}),
            F.lit(',"geometry":'),
            shape,
            F.lit("}"),
        ).alias("value")
    )


def write_features(df: DataFrame, path: str, geometry: str = "geometry") -> str:
    to_feature_lines(df, geometry).write.mode("overwrite").text(path)
    return path


def stack_bands(bands: dict[str, DataFrame], raster_id: str) -> tuple[DataFrame, dict[int, str]]:
    """Single-band tables ``(row, col, value)`` to one pixel table and its band names."""
    names = dict(enumerate(bands, start=1))
    parts = [
        df.select(
            F.lit(raster_id).alias("raster_id"), F.lit(number).alias("band"), "row", "col", "value"
        )
        for number, df in enumerate(bands.values(), start=1)
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked, names


def pixels_to_tiles(pixels: DataFrame, tile_size: int = 256) -> DataFrame:
    """Pixel rows to square tiles of row stride ``tile_size``; gaps are NULL.

    A group is one tile, so it never holds more than ``tile_size`` squared values.
    """
    keyed = pixels.select(
        "raster_id",
        "band",
        F.expr(f"CAST(row div {tile_size} AS INT)").alias("tile_row"),
        F.expr(f"CAST(col div {tile_size} AS INT)").alias("tile_col"),
        F.struct(
            (F.col("row") % tile_size * tile_size + F.col("col") % tile_size).alias("pos"), "value"
        ).alias("cell"),
    )
    tiles = keyed.groupBy("raster_id", "band", "tile_row", "tile_col").agg(
        F.array_sort(F.collect_list("cell")).alias("cells")
    )
    before = F.concat(F.array(F.lit(-1)), F.transform("cells", lambda c: c["pos"]))
    gap = F.lit(None).cast("double")
    filled = F.zip_with(
        "cells",
        F.slice(before, F.lit(1), F.size("cells")),
        lambda c, prev: F.concat(
            F.array_repeat(gap, c["pos"] - prev - 1), F.array(c["value"].cast("double"))
        ),
    )
    return tiles.select(
        "raster_id", "band", "tile_row", "tile_col", F.lit(tile_size).alias("tile_w"), F.flatten(filled).alias("data")
    )


def index_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles with ``low`` and ``high``, the range of their values without NULL and NaN (NULL without any)."""
    known = F.filter("data", lambda v: v.isNotNull() & ~F.isnan(v))
    return tiles.withColumns({"low": F.array_min(known), "high": F.array_max(known)})


def write_raster(pixels: DataFrame, path: str, tile_size: int = 256) -> str:
    """Tiles by raster with their value ranges, in order of place, so that a scan can skip by both."""
    tiles = index_tiles(pixels_to_tiles(pixels, tile_size))
    return write_parquet(tiles.sortWithinPartitions("raster_id", "band", "tile_row", "tile_col"), path, ("raster_id",))
