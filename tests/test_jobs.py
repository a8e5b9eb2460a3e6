"""Whole jobs on small inputs written to disk."""

import pytest
from pyspark.sql import functions as F

from terraquilt.config import JobConfig
from terraquilt.grid import GridSpec
from terraquilt.operators import rasterize as rz
from terraquilt.functions import geometry as geo
from terraquilt.plans import fixtures as fx, heat_job, trend_job
from terraquilt.sources import writers

SF_DIR = "/root/testdata/sf0.001"


def test_trend_job(spark, tmp_path):
    months = "\n".join(
        f"{y},{m},{y + m / 12:.3f},{-99.99 if (y, m) == (1960, 3) else 300 + 2 * (y - 1958)},{300 + y - 1958},30,0.1,0.2"
        for y in range(1957, 1970) for m in range(1, 13)
    )
    source = tmp_path / "co2.csv"
    source.write_text(
        "# preamble\nyear,month,decimal_date,average,deseasonalized,ndays,sdev,unc\n\n" + months + "\n"
    )
    trend = trend_job.run(spark, str(source), str(tmp_path / "out")).first()
    assert trend.slope == pytest.approx(2.0) and trend.r2 == pytest.approx(1.0) and trend.n_years == 12
    clean = spark.read.parquet(str(tmp_path / "out" / "clean_co2.parquet"))
    assert clean.count() == 12 * 12 - 1
    smooth = spark.read.parquet(str(tmp_path / "out" / "deseasonalized_co2.parquet"))
    assert smooth.where("year = 1960").first().avg_deseasonalized == pytest.approx(302.0)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Raw layers as JSON lines and a CSV of sites, derived from the smallest tables."""
    root = tmp_path_factory.mktemp("layers")
    text = F.expr(geo.geometry_to_geojson("geometry"))
    buildings = fx.buildings(spark, SF_DIR)
    attributes = F.to_json(F.struct(
        "bin", "cnstrct_yr", "heightroof", "base_bbl", "mpluto_bbl", "lstmoddate", "feat_code", "lststatype"
    ))
    record = F.concat(F.lit('{"the_geom":'), text, F.lit(","), F.substring(attributes, 2, 10_000))
    buildings.select(record.alias("value")).write.text(f"{root}/building")
    writers.write_features(fx.streets(spark, SF_DIR), f"{root}/street")
    zones = fx.zones(spark, SF_DIR).withColumnRenamed("id", "OBJECTID")
    for layer, code in heat_job.ZONE_CODES.items():
        writers.write_features(zones.select("OBJECTID", code, "geometry"), f"{root}/{layer}")
    fx.load(spark, SF_DIR, "points").select(F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude")).write.option(
        "header", True
    ).csv(f"{root}/sites")
    return {name: f"{root}/{name}" for name in ("building", "street", "nyco", "nysp", "nyzd", "sites")}


def test_heat_job(spark, inputs, tmp_path):
    grid = GridSpec(-74.02, 40.89, 0.0018, 0.0015, 100, 10)
    spectral = rz.bands_to_pixels(
        fx.load(spark, SF_DIR, "spectral"), "landsat_8", ["red", "blue", "green", "nir", "swir16", "swir22"]
    )
    spectral.write.parquet(f"{tmp_path}/landsat_8")
    for name in ("no2", "population", "canopy"):
        fx.load(spark, SF_DIR, "pixels").write.parquet(f"{tmp_path}/{name}")
    rasters = ("landsat_8", "no2", "population", "canopy")
    fine = GridSpec(-74.02, 40.89, 5 / 111035 / 2, 5 / 111035 / 2, 100, 10)
    cfg = JobConfig(
        catalogue=inputs | {n: f"{tmp_path}/{n}" for n in rasters}, grids={n: fine if n == "canopy" else grid for n in rasters}
    )
    target = str(tmp_path / "out")
    resolutions = {"building": (1000,), "street": (1000,), "nyco": (1000,), "nysp": (1000,), "nyzd": (1000, 500)}
    matrix = heat_job.run(spark, cfg, target, resolutions, sizes=(1,), multiline=False)
    columns = set(matrix.columns)
    assert {
        "building_height_res1000", "building_area_res1000_mean_3x3", "building_height_std_res1000_contrast_3x3",
        "street_width_res1000_std_dev_3x3", "var_res1000", "building_area_per_pixel_res1000",
        "has_park_res500_distance", "zonedist_level1_res1000", "sd_level2_res1000", "overlay_level1_res1000_mean_3x3",
        "ndvi_landsat_8", "albedo_landsat_8_mean_3x3", "landsat", "landsat_8_band_2", "no2", "no2_std_dev_3x3", "population",
        "canopy_average_res5", "canopy_count_res30",
    } <= columns
    assert not any(c.startswith("zonedist") and "contrast" in c for c in columns)
    assert matrix.count() == fx.load(spark, SF_DIR, "points").count()
    assert matrix.where("building_height_res1000 IS NULL OR has_park_res500_distance IS NULL").count() == 0

    # a sampled value equals the raster cell under the point
    grid = fx.grid(1000)
    site = matrix.first()
    row, col = int((grid.y1 - site.lat) / grid.py), int((site.long - grid.x0) / grid.px)
    cell = spark.read.parquet(f"{target}/rasters").where(
        f"raster_id = 'building_res1000' AND band = 1 AND row = {row} AND col = {col}"
    ).first()
    assert site.building_height_res1000 == cell.value

    # a second run adds nothing to the rasters
    before = spark.read.parquet(f"{target}/rasters").count()
    heat_job.rasterize_layers(spark, cfg, target, resolutions)
    assert spark.read.parquet(f"{target}/rasters").count() == before
