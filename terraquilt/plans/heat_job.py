"""Heat-feature job: raw layers to one table of features per site.

Stages hand over Parquet tables under one output folder, so a stage can be run again on its
own. Rasters are pixel tables partitioned by ``raster_id``; a raster already written is not
computed again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from terraquilt.config import JobConfig
from terraquilt.functions.indices import BAND_MAPS, INDEX_NAMES
from terraquilt.grid import GridSpec
from terraquilt.operators import distance, features as ft, focal, raster as rs, rasterize as rz, sampling
from terraquilt.operators.skew import salted_join
from terraquilt.session import small_table
from terraquilt.sources import readers, writers
from terraquilt.streaming import skip_existing

# Resolutions (metres) each layer is rasterised at.
LAYER_RESOLUTIONS = {
    "building": (30, 100),
    "street": (30, 100, 500, 1000),
    "nyco": (30,),
    "nysp": (30,),
    "nyzd": (30, 100, 200, 500, 1000),
}

# Bands of each layer, in order.
LAYER_BANDS = {
    "building": ["building_height", "building_height_std", "building_year", "building_area"],
    "street": ["street_width", "street_traffic", "street_lanes", "street_orientation", "street_type", "high_way"],
    "nyco": ["overlay_level2", "overlay_level1"],
    "nysp": ["sd_level1", "sd_level2"],
    "nyzd": ["zonedist_level1", "zonedist_level2", "zonedist_level3", *rz.ZONE_COUNT_BANDS],
}

BUILDING_SCHEMA = (
    "bin STRING, cnstrct_yr STRING, heightroof STRING, the_geom STRUCT<type: STRING, coordinates: STRING>, "
    "base_bbl STRING, mpluto_bbl STRING, lstmoddate STRING, feat_code STRING, lststatype STRING"
)
STREET_PROPERTIES = (
    "OBJECTID BIGINT, SegmentID STRING, Join_ID STRING, StreetCode STRING, Street STRING, TrafDir STRING, "
    "StreetWidth_Min INT, StreetWidth_Max INT, RW_TYPE STRING, POSTED_SPEED STRING, Number_Travel_Lanes STRING, "
    "Number_Park_Lanes STRING, Number_Total_Lanes STRING, FeatureTyp STRING, SegmentTyp STRING, BikeLane STRING, "
    "BIKE_TRAFDIR STRING, XFrom DOUBLE, YFrom DOUBLE, XTo DOUBLE, YTo DOUBLE, ArcCenterX DOUBLE, "
    "ArcCenterY DOUBLE, NodeIDFrom STRING, NodeIDTo STRING, NodeLevelF STRING, NodeLevelT STRING, "
    "TRUCK_ROUTE_TYPE STRING, Shape__Length DOUBLE, Status STRING"
)
ZONE_PROPERTIES = "OBJECTID BIGINT, {code} STRING, Shape__Area DOUBLE, Shape__Length DOUBLE"
ZONE_CODES = {"nyzd": "ZONEDIST", "nyco": "OVERLAY", "nysp": "SDLBL"}
ZONE_LEVELS = {"nyzd": ft.zoning_levels, "nyco": ft.overlay_levels, "nysp": ft.special_district_levels}


def extract_features(
    spark: SparkSession, cfg: JobConfig, target: str, predicate: str = "intersects", multiline: bool = True
) -> None:
    """Filter the raw layers and derive their attributes, one Parquet table per layer.

    ``multiline`` layers are one array or collection a file, read by many tasks; others are JSON lines.
    """
    records = readers.read_records(spark, cfg.path("building"), BUILDING_SCHEMA, multiline, split=multiline)
    buildings = ft.filter_buildings(readers.parse_geometry(records, "the_geom"), cfg, predicate)
    writers.write_parquet(ft.with_envelope(ft.building_features(buildings)), f"{target}/features/building")

    raw = readers.read_features(spark, cfg.path("street"), STREET_PROPERTIES, multiline, split=multiline)
    streets = ft.street_features(ft.filter_streets(raw, cfg, predicate))
    writers.write_parquet(ft.with_envelope(streets), f"{target}/features/street")

    for layer, code in ZONE_CODES.items():
        raw = readers.read_features(spark, cfg.path(layer), ZONE_PROPERTIES.format(code=code), multiline, split=multiline)
        zones = ZONE_LEVELS[layer](ft.filter_zoning(raw, cfg, predicate))
        writers.write_parquet(ft.with_envelope(zones), f"{target}/features/{layer}")


RASTERIZERS = {
    "building": rz.rasterize_buildings,
    "street": rz.rasterize_streets,
    "nyco": rz.rasterize_overlays,
    "nysp": rz.rasterize_special,
    "nyzd": rz.rasterize_zoning,
}


MANIFEST = "raster_id STRING, made_from STRING"


def _finished(spark: SparkSession, path: str) -> DataFrame:
    """Manifest of rasters whose write was completed, with what each was made from."""
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def _contents(table: DataFrame) -> str:
    """What a layer holds, whatever the order of its rows, in one pass."""
    entries = F.xxhash64(*[F.to_json(F.struct(c)) for c in sorted(table.columns)])
    rows, one, two = table.select(entries.alias("h")).agg(
        F.count(F.lit(1)), F.bit_xor("h"), F.bit_xor(F.xxhash64("h"))
    ).first()
    return f"rows {rows} {one} {two}"


def _write_raster(pixels: DataFrame, path: str) -> None:
    """Replace the partitions of these rasters and leave all others; safe to repeat."""
    pixels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("raster_id").parquet(path)


def rasterize_layers(spark: SparkSession, cfg: JobConfig, target: str, resolutions=None) -> dict[str, GridSpec]:
    """Every layer at each of its resolutions, into ``rasters``; returns the grids by raster name.

    A raster is left as it is if it was made from the same features on the same grid.
    """
    manifest = f"{target}/rasters_done"
    wanted = [(layer, r) for layer, sizes in (resolutions or LAYER_RESOLUTIONS).items() for r in sizes]
    grids = {f"{layer}_res{r}": GridSpec.from_bbox(cfg.bbox, r) for layer, r in wanted}
    features = {layer: spark.read.parquet(f"{target}/features/{layer}") for layer, _ in wanted}
    # grid and contents a raster depends on: other inputs or another box make another raster
    contents = {layer: _contents(table) for layer, table in features.items()}
    names = spark.createDataFrame(
        [(f"{layer}_res{r}", f"{grids[f'{layer}_res{r}']} {contents[layer]}") for layer, r in wanted], MANIFEST
    )
    todo = {r.raster_id for r in skip_existing(names, _finished(spark, manifest), ["raster_id", "made_from"]).collect()}
    for layer, resolution in wanted:
        raster_id = f"{layer}_res{resolution}"
        if raster_id in todo:
            cells = RASTERIZERS[layer](features[layer], grids[raster_id])
            _write_raster(rz.bands_to_pixels(cells, raster_id, LAYER_BANDS[layer]), f"{target}/rasters")
            names.where(F.col("raster_id") == raster_id).write.mode("append").parquet(manifest)
    return grids


# Resolutions (metres) the canopy heights are resampled at.
CANOPY_RESOLUTIONS = (5, 10, 30)


def prepare_rasters(spark: SparkSession, cfg: JobConfig, target: str) -> tuple[dict[str, GridSpec], list[tuple]]:
    """The raster inputs of ``cfg.grids``, into ``rasters``; returns grids and (raster, band, name) rows.

    Sensors are copied with their first band named and give 16 indices, gases and aerosols are
    copied likewise, the population is clipped to the study area, and canopy heights are
    resampled to average and count.
    """
    grids: dict[str, GridSpec] = {}
    bands: list[tuple] = []

    def put(pixels: DataFrame, raster_id: str, grid: GridSpec, names: list[str]) -> None:
        _write_raster(pixels.withColumn("raster_id", F.lit(raster_id)).select(*rs.PIXEL_COLUMNS), f"{target}/rasters")
        grids[raster_id] = grid
        bands.extend((raster_id, i, name) for i, name in enumerate(names, start=1))

    for name, grid in cfg.grids.items():
        pixels = spark.read.parquet(cfg.path(name)).select(*rs.PIXEL_COLUMNS)
        kind = name.split("_")[0]
        if kind == "canopy":
            extent = small_table(spark, [(name, grid.height, grid.width)], "raster_id string, height int, width int")
            heights = pixels.withColumn("raster_id", F.when(F.col("row").isNotNull(), F.lit(name)))
            for resolution in CANOPY_RESOLUTIONS:
                block = rs.canopy_block(resolution, grid.px)
                wide = rs.resample_canopy(heights, extent, block)
                raster_id = f"canopy_res{resolution}"
                coarse = GridSpec(
                    grid.x0, grid.y1, grid.px * block, grid.py * block, -(-grid.width // block), -(-grid.height // block), grid.srid
                )
                names = [f"canopy_average_res{resolution}", f"canopy_count_res{resolution}"]
                put(rz.bands_to_pixels(wide, raster_id, ["average", "count"]), raster_id, coarse, names)
            continue
        if kind == "population":
            clipped, window = rs.clip_bbox(pixels, grid, cfg.bbox)
            put(clipped, name, window, [name])
            continue
        count = pixels.agg(F.max("band")).first()[0] or 0
        meta = spark.createDataFrame([(name, i, f"{name}_band_{i}") for i in range(1, count + 1)], "raster_id string, band int, name string")
        copied, described = rs.copy_described(pixels, meta, kind)
        put(copied, name, grid, [r["name"] for r in described.orderBy("band").collect()])  # a band a row
        if name in BAND_MAPS:
            put(rs.sensor_indices(pixels, name), f"{name}_indices", grid, [f"{i}_{name}" for i in INDEX_NAMES])
    return grids, bands


def layer_band_table(spark: SparkSession, grids: dict[str, GridSpec], more: list[tuple] = ()) -> DataFrame:
    """Band names ``<band>_res<N>`` of the rasterised layers, and the given ones of other rasters."""
    rows = list(more)
    for raster_id in grids:
        if raster_id in {r for r, _, _ in more}:
            continue
        layer, resolution = raster_id.rsplit("_res", 1)
        rows += [(raster_id, i, f"{b}_res{resolution}") for i, b in enumerate(LAYER_BANDS[layer], start=1)]
    return small_table(spark, rows, "raster_id string, band int, name string")


def _wide(pixels: DataFrame, raster_id: str, names: dict[int, str]) -> DataFrame:
    return rs.bands_to_columns(pixels.where(F.col("raster_id") == raster_id), names)


def engineer_features(
    spark: SparkSession, cfg: JobConfig, target: str, grids: dict[str, GridSpec], sizes: tuple[int, ...] | None = None,
    bands: list[tuple] = (),
) -> DataFrame:
    """Ratios, zoning distances and neighbourhood features; one long table of named pixels.

    Distances are taken of the finest zoning raster. Columns: ``raster_id, name, row, col, value``.
    """
    pixels = spark.read.parquet(f"{target}/rasters")
    meta = layer_band_table(spark, grids, bands)
    long = ("raster_id", "name", "row", "col", "value")
    named = pixels.join(meta, ["raster_id", "band"]).select(*long)

    for raster_id in [r for r in grids if r.startswith("building_res")]:
        resolution = int(raster_id.removeprefix("building_res"))
        if f"street_res{resolution}" not in grids:
            continue
        built = _wide(pixels, raster_id, {1: "building_height", 4: "building_area"})
        roads = _wide(pixels, f"street_res{resolution}", {1: "street_width"})
        ratio = rs.height_width_ratio(built, roads, resolution)
        entries = F.array(*[
            F.struct(F.lit(f"{c}_res{resolution}").alias("name"), F.col(c).alias("value"))
            for c in ("var", "building_area_per_pixel")
        ])
        named = named.unionByName(
            ratio.select(F.lit(raster_id).alias("raster_id"), "row", "col", F.inline(entries)).select(*long)
        )

    zoning = sorted((r for r in grids if r.startswith("nyzd_res")), key=lambda r: int(r.removeprefix("nyzd_res")))
    if zoning:
        counts = pixels.where((F.col("raster_id") == zoning[0]) & (F.col("band") >= 4))
        distances, names = distance.zoning_distance(counts, meta)
        named = named.unionByName(distances.join(names, ["raster_id", "band"]).select(*long))

    for size in cfg.window_sizes if sizes is None else sizes:
        named = named.unionByName(focal.neighbourhood_features(pixels, meta, size, dense=True).select(*long))
    return named


def run(
    spark: SparkSession, cfg: JobConfig, target: str, resolutions=None, sizes: tuple[int, ...] | None = None,
    multiline: bool = True,
) -> DataFrame:
    """All stages; returns the site table with one column per feature and writes it as CSV."""
    extract_features(spark, cfg, target, multiline=multiline)
    more, bands = prepare_rasters(spark, cfg, target)
    grids = rasterize_layers(spark, cfg, target, resolutions) | more
    writers.write_parquet(
        engineer_features(spark, cfg, target, grids, sizes, bands), f"{target}/features_long", ("raster_id",)
    )
    pixels = spark.read.parquet(f"{target}/features_long")
    sites = spark.read.csv(cfg.path("sites"), header=True, schema="Latitude DOUBLE, Longitude DOUBLE").select(
        F.struct("Latitude", "Longitude").alias("point_id"),  # the coordinates themselves, not a hash of them
        F.col("Latitude").alias("lat"),
        F.col("Longitude").alias("lon"),
    )
    samples = salted_join(sampling.point_cells(sites.distinct(), grids), pixels, ["raster_id", "row", "col"]).select(
        "point_id", F.col("name").alias("feature"), "value"
    )
    # the set of names is fixed by bands, resolutions and windows; it does not grow with the data
    named = pixels.select("raster_id", "name").distinct().collect()
    names = sorted({r["name"] for r in named})
    if len(named) > len(names):
        raise ValueError("two rasters have a band of the same name")
    matrix = sites.select("point_id", "lat", F.col("lon").alias("long")).join(
        sampling.assemble_matrix(samples, names), "point_id", "left"
    )
    # sampled once: the CSV is made of the stored table
    stored = spark.read.parquet(writers.write_parquet(matrix, f"{target}/sites"))
    writers.write_csv(stored.drop("point_id"), f"{target}/sites.csv")
    return stored
