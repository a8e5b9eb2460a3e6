"""Statistics per cell as states that can be stored and merged: new and removed features touch their cells only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terraquilt.grid import GridSpec
from terraquilt.operators.cover import EMPTY, ENTROPY_BIN, ENTROPY_LIMIT, on_grid

#: Sums that a state holds for each cell.
_SUMS = ("members", "n", "s", "ss")


def cell_states(cover: DataFrame, value: Column, code: Column | None = None, sign: int = 1) -> DataFrame:
    """States of the cells of a cover: one row per cell and category with its sums.

    ``category`` is ``code`` (NULL as a category of its own, none without ``code``), ``bin`` the entropy bin of the
    value (NULL outside of all). members counts features, n those with a value (NULL and NaN are none), s and ss sum
    values and squares, as decimals so that adding and taking away again leaves nothing behind. With
    ``sign=-1`` the state of features that are taken away.
    """
    v = F.when(~F.isnan(value.cast("double")), value.cast("double"))
    exact = v.cast("decimal(28,8)")
    square = (exact * exact).cast("decimal(38,12)")
    bin_ = F.when((v >= 0) & (v < ENTROPY_LIMIT), F.floor(v / ENTROPY_BIN).cast("int"))
    category = F.lit(None).cast("int") if code is None else code.cast("int")
    rows = cover.select("row", "col", category.alias("category"), bin_.alias("bin"), exact.alias("v"), square.alias("vv"))
    times = F.lit(sign)
    return rows.groupBy("row", "col", "category", "bin").agg(
        (F.count(F.lit(1)) * times).alias("members"), (F.count("v") * times).alias("n"),
        F.coalesce(F.sum("v") * times, F.lit(0)).cast("decimal(38,8)").alias("s"),
        F.coalesce(F.sum("vv") * times, F.lit(0)).cast("decimal(38,12)").alias("ss"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """One state out of several, in any order; what was taken away wholly leaves no row."""
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    sums = [F.sum(c).cast(dict(states[0].dtypes)[c]).alias(c) for c in _SUMS]
    return both.groupBy("row", "col", "category", "bin").agg(*sums).where("members <> 0")


def touched_cells(delta: DataFrame) -> DataFrame:
    return delta.select("row", "col").distinct()


def state_statistics(state: DataFrame) -> DataFrame:
    """mean, std_dev, count, presence, mode and entropy of the cells that a state has.

    The state is read once: its sums by bin and its members by category are grouping sets of one aggregation.
    """
    sets = state.groupingSets([["row", "col", "bin"], ["row", "col", "category"]], "row", "col", "bin", "category").agg(
        F.grouping("bin").alias("_coded"), *[F.sum(c).alias(c) for c in _SUMS]
    ).withColumn("_keyed", F.expr("row IS NOT NULL AND col IS NOT NULL"))  # a cell without number has neither mode nor entropy

    def of(aggregate: str, rows: str) -> Column:
        return F.expr(f"{aggregate} FILTER (WHERE {rows})")

    binned, coded = "_coded = 0 AND _keyed AND bin IS NOT NULL", "_coded = 1 AND _keyed AND category IS NOT NULL"
    k, n = of("sum(n)", binned), of("sum(n)", "_coded = 0")
    mean = of("sum(s)", "_coded = 0").cast("double") / F.nullif(n, F.lit(0))
    variance = of("sum(ss)", "_coded = 0").cast("double") / F.nullif(n, F.lit(0)) - mean * mean
    entropy = F.greatest(F.ln(k) - of("sum(n * ln(n))", binned) / k, F.lit(0.0))
    return sets.groupBy("row", "col").agg(
        mean.alias("mean"), F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std_dev"), n.alias("count"),
        F.least(n, F.lit(1)).alias("presence"), of("min_by(category, struct(-members, category))", coded).alias("mode"),
        F.when(of("count(1)", binned) > 0, entropy).alias("entropy"),
    )


def state_on_grid(state: DataFrame, grid: GridSpec) -> DataFrame:
    """The statistics of every cell of the grid, with the values of empty cells where nothing is left."""
    names = ("mean", "std_dev", "count", "presence", "mode", "entropy")
    return on_grid(state_statistics(state), grid, {name: EMPTY[name] for name in names})
