"""Input tables: series CSV, JSON records, GeoJSON features, raster tiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from terraquilt.functions import geometry as geo
from terraquilt.sources.json_split import read_objects


def read_series(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Monthly series CSV with ``#`` preamble, padded cells and blank lines."""
    rows = spark.read.csv(
        path,
        schema=ddl,
        header=True,
        comment="#",
        mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
    return rows.dropna(how="all")


def missing_uncertainty_to_null(series: DataFrame, columns: list[str]) -> DataFrame:
    """Negative uncertainty is a sentinel for "not computed"."""
    return series.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in columns})


def read_records(spark: SparkSession, path: str, schema, multiline: bool = True, split: bool = False) -> DataFrame:
    """JSON records with an explicit schema.

    A multiline file is one task however large it is; pass ``split=True`` to read a large one by
    many tasks, or ``multiline=False`` for JSON lines.
    """
    if split:
        return _parsed(read_objects(spark, path), schema)
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def _parsed(objects: DataFrame, schema) -> DataFrame:
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return objects.select(F.from_json("value", declared).alias("r")).select("r.*")


def feature_schema(properties: T.StructType | str) -> T.StructType:
    """Schema of one GeoJSON feature; coordinates stay text until their depth is known."""
    props = properties if isinstance(properties, T.StructType) else T.StructType.fromDDL(properties)
    return T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("geometry", T.StructType.fromDDL("type STRING, coordinates STRING")),
        T.StructField("properties", props),
    ])


def collection_schema(properties: T.StructType | str) -> T.StructType:
    return T.StructType([T.StructField("features", T.ArrayType(feature_schema(properties)))])


def flatten_features(df: DataFrame) -> DataFrame:
    """One row per feature with its properties as columns, from a collection or from features.

    A table that already is at property level passes through unchanged.
    """
    if "features" in df.columns:
        df = df.select(F.explode("features").alias("f")).select("f.*")
    if "properties" in df.columns:
        lead = [c for c in ("id", "geometry") if c in df.columns]
        df = df.select(*lead, "properties.*")
    return df


def parse_geometry(features: DataFrame, column: str = "geometry") -> DataFrame:
    """GeoJSON struct column to the normal form; NULL geometry is kept."""
    return features.withColumn(column, F.expr(geo.geometry_from_geojson(column)))


def read_features(spark: SparkSession, path: str, properties, multiline: bool = True, split: bool = False) -> DataFrame:
    """GeoJSON collection (or feature lines with ``multiline=False``) in the normal form.

    With ``split=True`` a collection is read by many tasks, a feature at a time, instead of as one row.
    """
    if split:
        return parse_geometry(flatten_features(_parsed(read_objects(spark, path, "features"), feature_schema(properties))))
    schema = collection_schema(properties) if multiline else feature_schema(properties)
    raw = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return parse_geometry(flatten_features(raw))


def tiles_to_pixels(tiles: DataFrame, tile_size: int) -> DataFrame:
    """Tile table ``(raster_id, band, tile_row, tile_col, tile_w, data)`` to pixel rows.

    NULL entries of ``data`` are nodata and yield no pixel.
    """
    pixels = tiles.select(
        "raster_id", "band", "tile_row", "tile_col", "tile_w", F.posexplode("data").alias("pos", "value")
    ).where(F.col("value").isNotNull())
    return pixels.select(
        "raster_id",
        "band",
        (F.col("tile_row") * tile_size + F.expr("pos div tile_w")).cast("int").alias("row"),
        (F.col("tile_col") * tile_size + F.col("pos") % F.col("tile_w")).cast("int").alias("col"),
        "value",
    )


def tiles_in_window(tiles: DataFrame, tile_size: int, rows: tuple[int, int], cols: tuple[int, int], low: float | None = None,
                    high: float | None = None) -> DataFrame:
    """Tiles that reach into the half-open rows and columns, and whose values reach ``low`` to ``high`` where given.

    Plain comparisons of the index columns, so a scan of stored tiles skips what it doesn't need. Tiles without
    any value have no range and are left out where one is asked for.
    """
    if rows[0] >= rows[1] or cols[0] >= cols[1]:
        return tiles.where(F.lit(False))
    found = tiles.where(
        F.col("tile_row").between(rows[0] // tile_size, (rows[1] - 1) // tile_size)
        & F.col("tile_col").between(cols[0] // tile_size, (cols[1] - 1) // tile_size)
    )
    found = found.where(F.col("high") >= low) if low is not None else found
    return found.where(F.col("low") <= high) if high is not None else found


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns a table lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
