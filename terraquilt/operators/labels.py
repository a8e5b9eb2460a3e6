"""Category codes and group-wise filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from terraquilt.operators.quantiles import exact_percentiles
from terraquilt.session import broadcast_if_small, cut_lineage, fits_broadcast

def _labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(_column, _label)``: the distinct values of all columns, in one pass over ``df``."""
    entries = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_label")) for c in columns])
    return df.select(F.inline(entries)).where(F.col("_label").isNotNull()).distinct()


def label_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(_column, _label, _code)``: 0-based positions among the sorted distinct values of each column.

    The label set may be of any size. It is settled and counted; one that may be broadcast is numbered as it
    is and comes with the hint. A larger one is range-sorted, numbered within each partition, and
    shifted by the counts of a column's earlier partitions.
    """
    labels = cut_lineage(_labels(df, columns))
    if fits_broadcast(labels):
        place = F.row_number().over(Window.partitionBy("_column").orderBy("_label")) - 1  # counted above
        return F.broadcast(labels.withColumn("_code", place.cast("int")))
    return _sorted_codes(labels)


def _sorted_codes(labels: DataFrame) -> DataFrame:
    """Codes of a label set of any size. It is checkpointed because its partition numbers are read twice."""
    ids = cut_lineage(labels.repartitionByRange("_column", "_label").select("*", F.spark_partition_id().alias("_part")))
    sizes = ids.groupBy("_column", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per column and partition of the label set
    before = Window.partitionBy("_column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_column", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_column", "_part").orderBy("_label")) - 1
    return ids.withColumn("_row", within).join(shifts, ["_column", "_part"]).select(
        "_column", "_label", (F.col("_shift") + F.col("_row")).cast("int").alias("_code")
    )


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each category (text) by its 0-based position among the sorted distinct values.

    Byte order, as in ``'MX-9' < 'MiD'``; NULL stays NULL. The codes are broadcast if their
    counted rows allow, and joined like any table otherwise.
    """
    codes = label_codes(df, columns)
    encoded = df
    for c in columns:
        of_column = codes.where(F.col("_column") == c).select(F.col("_label").alias(f"_l_{c}"), "_code")
        encoded = encoded.join(of_column, encoded[c] == F.col(f"_l_{c}"), "left").withColumn(c, F.col("_code")).drop("_code", f"_l_{c}")
    return encoded.select(*df.columns)


def _medians(source: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Medians of any number of rows, all columns in one percentile job."""
    long = source.select(
        F.col(group).alias("_group"),
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_x")) for c in columns
        ])),
    )
    medians = exact_percentiles(long, ["_group", "_column"], "_x", {"_median": 0.5})
    return medians.groupBy("_group").agg(*[
        F.max(F.when(F.col("_column") == c, F.col("_median"))).alias(f"_m{i}") for i, c in enumerate(columns)
    ])


def group_median_fill(
    df: DataFrame, group: str, columns: list[str], medians_from: DataFrame | None = None
) -> DataFrame:
    """Replace NULL by the median of the row's group; a group without values keeps NULL.

    ``medians_from`` may name a cheaper table with the same groups and columns to take the
    medians from. The medians are broadcast if the groups are few, because a join on a handful
    of groups would pile them up.
    """
    wide = broadcast_if_small(_medians(df if medians_from is None else medians_from, group, columns))
    filled = df.join(wide, df[group].eqNullSafe(wide["_group"]), "left").withColumns({
        c: F.coalesce(F.col(c), F.col(f"_m{i}")) for i, c in enumerate(columns)
    })
    return filled.select(*df.columns)
