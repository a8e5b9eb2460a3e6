"""Exact percentiles without bringing a group into one task.

Spark's own ``percentile`` keeps every distinct value of a group in one map, and as a
window it puts the whole group into one partition. Here a bounded sketch first brackets
each wanted rank; one more partial aggregation counts what lies below the bracket, and
only the values inside it (at most about ``4 * MARGIN`` of the group) are ranked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from terraquilt.session import broadcast_if_small

# The sketch is off by at most n / ACCURACY ranks; the bracket is twice that wide on either side.
ACCURACY = 50000
MARGIN = 2.0 / ACCURACY


def _same(left: DataFrame, keys: list[str], right: DataFrame):
    """NULL-safe equality of the keys with their numbered copies on the other side."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per key with a column per wanted percentile (linear interpolation).

    NULL and NaN are skipped; a key without values gets NULL. ``probs`` maps the output
    name to the probability. At least one key column is needed.
    """
    if not keys:
        raise ValueError("exact_percentiles needs at least one key column")
    names = list(probs)
    number = F.col(value).cast("double")
    numbers = df.select(*keys, F.when(~F.isnan(number), number).alias("_v"))

    low = [max(0.0, probs[n] - MARGIN) for n in names]
    high = [min(1.0, probs[n] + MARGIN) for n in names]
    sketch = numbers.groupBy(*keys).agg(
        F.percentile_approx("_v", low + high, ACCURACY).alias("_q"),
        F.count("_v").alias("_total"),
    )
    wanted = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.element_at("_q", i + 1).alias("lo"),
            F.element_at("_q", i + 1 + len(names)).alias("hi"),
            (F.lit(probs[name]) * (F.col("_total") - 1)).alias("at"),
        )
        for i, name in enumerate(names)
    ])
    brackets = broadcast_if_small(
        sketch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], wanted.alias("_wanted"))
    )

    counted = numbers.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = counted.join(brackets, _same(counted, keys, brackets)).select(
        *keys, "_v", "_n", F.explode("_wanted").alias("w")
    )

    under, over = F.col("_v") < F.col("w.lo"), F.col("_v") > F.col("w.hi")
    outside = ranked.groupBy(*keys, F.col("w.name").alias("_name")).agg(
        F.first("w.at").alias("_at"),
        F.sum(F.when(under, F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(~under & ~over, F.col("_n")).otherwise(0)).alias("_within"),
        # rounding may leave the wanted rank one place outside the bracket
        F.max(F.when(under, F.col("_v"))).alias("_before"),
        F.min(F.when(over, F.col("_v"))).alias("_after"),
    )
    running = Window.partitionBy(*keys, "w.name").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    # coalesced, so that no NULL filter is derived and both branches read one shuffle of counts
    bracketed = F.coalesce((F.col("_v") >= F.col("w.lo")) & (F.col("_v") <= F.col("w.hi")), F.lit(False))
    inside = ranked.where(bracketed).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("w.name").alias("_in"),
        "_v",
        "_n",
        F.sum("_n").over(running).alias("_upto"),
    )
    last = F.col("_below") + F.col("_upto") - 1
    first = last - F.col("_n") + 1

    def value_at(name: str, rank):
        value = (
            F.when((first <= rank) & (last >= rank), F.col("_v"))
            .when(rank < F.col("_below"), F.col("_before"))
            .when(rank >= F.col("_below") + F.col("_within"), F.col("_after"))
        )
        return F.max(F.when(F.col("_name") == name, value))

    at = F.col("_at")
    placed = outside.join(inside, _same(outside, keys, inside) & (F.col("_name") == F.col("_in")), "left")
    found = placed.groupBy(*keys).agg(*[
        c
        for i, n in enumerate(names)
        for c in (
            value_at(n, F.floor(at)).alias(f"_a{i}"),
            value_at(n, F.ceil(at)).alias(f"_b{i}"),
            F.max(F.when(F.col("_name") == n, at - F.floor(at))).alias(f"_t{i}"),
        )
    ])
    return found.select(*keys, *[
        (F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_t{i}")).alias(n)
        for i, n in enumerate(names)
    ])
