"""Profiles of code columns: how often which pattern occurs, with examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from terraquilt.functions.text import code_pattern, suggested_regex


def pattern_counts(df: DataFrame, column: str, examples: int = 3) -> DataFrame:
    """Pattern, number of rows and the first few distinct values in order.

    Values are counted before patterns, so a frequent pattern is never gathered whole; the
    row number filter is pushed below the shuffle and leaves a few rows per task.
    """
    value = F.coalesce(F.col(column).cast("string"), F.lit("NA"))
    values = df.groupBy(value.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    tagged = values.withColumn("pattern", code_pattern(F.col("_value")))
    counts = tagged.groupBy("pattern").agg(F.sum("_n").alias("count"))
    first = Window.partitionBy("pattern").orderBy("_value")
    samples = (
        tagged.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= examples)
        .groupBy("pattern")
        # the count comes along unused, so that both branches read one shuffle of counted values
        .agg(F.array_sort(F.collect_list(F.struct("_value", "_n"))).alias("_found"))
        .select("pattern", F.transform("_found", lambda e: e["_value"]).alias("examples"))
    )
    return counts.join(samples, "pattern")


def patterns_by_frequency(patterns: DataFrame) -> DataFrame:
    return patterns.orderBy(F.desc("count"), "pattern")


def with_suggested_regex(patterns: DataFrame, compat: bool = False) -> DataFrame:
    return patterns.withColumn("suggested_regex", suggested_regex(F.col("pattern"), compat))
