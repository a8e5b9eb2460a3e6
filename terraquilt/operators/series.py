"""Monthly series: cleaning, annual means, linear trends."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F


def series_clean(series: DataFrame, first_year: int = 1958) -> DataFrame:
    """Measured months only: positive mean, known year, real month."""
    return series.where(
        (F.col("average") > 0) & (F.col("year") >= first_year) & F.col("month").between(1, 12)
    )


def annual_means(series: DataFrame, columns: dict[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean per year of several columns in one aggregation; ``columns`` maps input to output name."""
    means = [F.avg(source).alias(name) for source, name in columns.items()]
    return series.groupBy(*keys, "year").agg(*means).orderBy(*keys, "year")


def with_gas(series: DataFrame, gas: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Tag a series with its gas and align differing column names."""
    return series.withColumnsRenamed(renames or {}).withColumn("gas", F.lit(gas))


def linear_trend(annual: DataFrame, value: str, keys: tuple[str, ...] = (), origin: int = 1990) -> DataFrame:
    """Least-squares line per key: slope, intercept and R squared in one pass.

    Years are taken relative to ``origin`` so the sums of squares keep their digits;
    the intercept is moved back to year zero.
    """
    year = (F.col("year") - origin).cast("double")
    y = F.col(value)
    fitted = annual.groupBy(*keys).agg(
        F.regr_slope(y, year).alias("slope"),
        F.regr_intercept(y, year).alias("_at_origin"),
        F.regr_r2(y, year).alias("r2"),
        F.count(y).alias("n_years"),
    )
    return fitted.select(
        *keys,
        "slope",
        (F.col("_at_origin") - F.col("slope") * origin).alias("intercept"),
        "r2",
        "n_years",
    )


def linear_trend_model(annual: DataFrame, value: str):
    """The same line as a fitted MLlib model; returns the model and the annual table with predictions."""
    assembler = VectorAssembler(inputCols=["year"], outputCol="features")
    regression = LinearRegression(featuresCol="features", labelCol=value, predictionCol="prediction")
    features = assembler.transform(annual.where(F.col(value).isNotNull()))
    model = regression.fit(features)
    return model, model.transform(features).drop("features")
