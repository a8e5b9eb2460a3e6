"""Gas trend job: series file to clean months, annual means and a linear trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraquilt.config import SERIES_DDL
from terraquilt.operators import series
from terraquilt.sources import readers, writers


def run(spark: SparkSession, source: str, target: str, gas: str = "co2") -> DataFrame:
    """Write ``clean``, ``annual`` and ``deseasonalized`` tables and return the trend line.

    The file is scanned once; everything after the clean table reads that.
    """
    rows = readers.read_series(spark, source, SERIES_DDL[gas])
    unsure = [c for c in rows.columns if c.endswith("unc")]
    clean_path = writers.write_parquet(
        series.series_clean(readers.missing_uncertainty_to_null(rows, unsure)), f"{target}/clean_{gas}.parquet"
    )
    clean = spark.read.parquet(clean_path)
    smooth = "deseasonalized" if gas == "co2" else "trend"
    means = {"average": "avg_value", smooth: "avg_deseasonalized"}
    annual = series.annual_means(clean, means)
    writers.write_parquet(annual.select("year", "avg_value"), f"{target}/annual_{gas}.parquet")
    writers.write_parquet(annual.select("year", "avg_deseasonalized"), f"{target}/deseasonalized_{gas}.parquet")
    return series.linear_trend(spark.read.parquet(f"{target}/annual_{gas}.parquet"), "avg_value")
