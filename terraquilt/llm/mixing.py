"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraquilt.llm.common import count_words, number_rows, settle, text_of
from terraquilt.session import broadcast_if_small


def water_fill(sources: DataFrame, total: Column, max_epochs: float = 2.0) -> DataFrame:
    """Targets for sources with ``weight`` and ``source_size``: shares of ``total`` by weight, none above its cap.

    Clamping a source at max_epochs times its size and resharing the excess by weight, until none
    is above, ends at one level L: a source gets the less of its cap and ``L * weight``. With the
    sources in order of cap / weight, those clamped come first, and L is what is left over the
    weights that are left, at the first source it doesn't clamp. Where even all caps together
    fall short of the total, every source is at its cap. One row per source, so a table as small
    as the list of sources.
    """
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    ranked = sources.withColumn("_cap", cap).withColumn("_full_at", F.col("_cap") / F.col("weight"))
    order = Window.orderBy("_full_at", F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = (
        ranked.withColumn("_place", F.row_number().over(order))
        .withColumn("_spent", F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
        .withColumn("_weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("_level", (total - F.col("_spent")) / F.col("_weight_left"))
    )
    first = F.min(F.when(F.col("_full_at") >= F.col("_level"), F.struct("_place", "_level"))).over(everything)["_level"]
    target = F.when(first.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), first * F.col("weight")))
    return filled.withColumn("target", target).select(*sources.columns, "target")


def _draw(key: Column, text: Column, seed: int) -> Column:
    """63 bits from key and text, so only rows that repeat both share a draw."""
    return F.shiftrightunsigned(F.xxhash64(key, text_of(text), F.lit(seed)), 1)


def _sizes(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), count_words(text).alias("size"),
        _draw(F.col(key), F.col(text), seed).alias("draw"), F.monotonically_increasing_id().alias("row"),
    )


def _edge_rows(rows: DataFrame, group: str, row: str, taken: str) -> DataFrame:
    """``rows``, all repeats of the edge draw of their source, with ``_in``: whether a row is of the ``taken`` first ones.

    Numbered by blocks of the hash of their row numbers, so that no task gets all repeats of one text.
    """
    named = rows.withColumn("_group", F.coalesce(F.xxhash64(F.col(group), F.col(group).isNull()), F.lit(0)))
    return number_rows(named, ["_group"], [row], "_nth").withColumn("_in", F.col("_nth") < F.col(taken)).drop("_group", "_nth")


def mix_rates(sized: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """Per source: source_size, target, whole repetitions, the draw up to which documents enter once more, and the
    edge draw of which only edge_taken repeats do (NULL if no repeats are divided).

    ``sized`` has source, size and draw. Words are summed by range of draws first; only the one
    range that a target falls into is put in order, so no task gets a whole source.
    """
    block = F.shiftright("draw", 51).cast("int")
    blocks = settle(sized.groupBy("source", block.alias("block")).agg(F.sum("size").alias("words")), "mix-blocks")
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = blocks.groupBy("source").agg(F.sum("words").alias("source_size")).withColumn("weight", weight)
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    targets = water_fill(sources.withColumn("total", total), F.col("total"), max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    targets = settle(
        targets.withColumn("whole", F.floor(rate).cast("long")).withColumn(
            "rest", F.col("target") - F.col("whole") * F.col("source_size")
        ).select("source", "source_size", "target", "whole", "rest"),
        "mix-targets",
    )
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        blocks.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).alias("b")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
        .select(F.col("b.source").alias("source"), "block", "before", "rest")
    )
    inside = sized.withColumn("block", block).alias("d").join(
        edges.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.block") == F.col("e.block"))
    ).groupBy(F.col("d.source").alias("source"), F.col("d.block").alias("block"), "draw").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"), F.min("before").alias("before"), F.min("rest").alias("rest")
    )
    # repeats are one row here, so that a text that many rows hold is one
    running = Window.partitionBy("source", "block").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("rest") - (F.col("before") + F.sum("words").over(running) - F.col("words"))
    whole = F.when(left >= 0, F.col("rows")).otherwise(F.lit(0))
    fit = F.floor(left * F.col("rows") / F.when(F.col("words") > 0, F.col("words")) + F.lit(0.5))
    taken = F.greatest(F.lit(0), F.least(F.col("rows"), F.coalesce(fit, whole))).cast("long")
    start = F.shiftleft(F.col("block").cast("long"), 51) - 1
    divided = (F.col("taken") > 0) & (F.col("taken") < F.col("rows"))
    cuts = inside.withColumn("taken", taken).groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("taken") == F.col("rows"), F.col("draw"))), F.max(start)).alias("cut"),
        F.max(F.when(divided, F.col("draw"))).alias("edge"), F.max(F.when(divided, F.col("taken"))).alias("edge_taken"),
    )
    return targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("t.source").alias("source"), "source_size", "target", "whole", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut"),
        "edge", "edge_taken",
    )


def _with_rates(rows: DataFrame, rates: DataFrame, source: str, columns: list) -> DataFrame:
    """Every row with its source's rates; the table of sources is broadcast if its counted rows allow."""
    return rows.alias("d").join(
        broadcast_if_small(rates).alias("r"), F.col(f"d.`{source}`").eqNullSafe(F.col("r.source"))
    ).select(*columns)


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, max_epochs: float = 2.0,
             seed: int = 23, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often each document enters the mix: key, source, size, source_size, target, repeats, taken.

    size counts the words of the text (NULL: 0). Sources in code point order, NULL last as a
    source of its own, take the weights in turn. A source enters target / source_size times: all
    its documents the whole number of times, and once more those that come first in the order of
    a seeded hash of key and text, until the words come nearest the target (the document at the edge
    is in if that brings them nearer). So a source misses its target by at most half a document
    (of rows that repeat key and text, as many as needed enter once more), and no document enters more than
    max_epochs times, rounded up. A source without words has target 0; its documents enter once, as they
    cost nothing. Columns other than the three named are left out; an empty table gives one.
    """
    sized = settle(_sizes(docs, key, text, source, seed), "mix-sizes")
    rates = mix_rates(sized, weights, share, max_epochs)
    rated = _with_rates(sized, rates, "source", ["d.*", "source_size", "target", "whole", "cut", "edge", "edge_taken"])
    at_edge = F.coalesce(F.col("draw") == F.col("edge"), F.lit(False))
    rest = rated.where(~at_edge).withColumn("_in", F.col("draw") <= F.col("cut"))
    repeats = F.col("whole") + F.col("_in").cast("long")
    return rest.unionByName(_edge_rows(rated.where(at_edge), "source", "row", "edge_taken")).select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, max_epochs: float = 2.0,
                  seed: int = 23, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, each as often as ``mix_plan`` says, with the columns of ``docs``.

    Texts aren't shuffled, but for the repeats of which some enter once more and some don't. A
    document is one struct beside the columns needed, so its own may have any name.
    """
    sized = settle(_sizes(docs, key, text, source, seed), "mix-sizes")
    rates = mix_rates(sized, weights, share, max_epochs)
    rates = settle(rates, "mix-rates")
    whole = docs.select(
        F.col(source).alias("source"), _draw(F.col(key), F.col(text), seed).alias("draw"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
    )
    rated = _with_rates(whole, rates, "source", ["d.*", "whole", "cut", "edge", "edge_taken"])
    at_edge = F.coalesce(F.col("draw") == F.col("edge"), F.lit(False))
    rest = rated.where(~at_edge).withColumn("_in", F.col("draw") <= F.col("cut"))
    edge = settle(rated.where(at_edge).withColumn("row", F.monotonically_increasing_id()), "mix-edge")
    mixed = rest.unionByName(_edge_rows(edge, "source", "row", "edge_taken").drop("row"))
    times = (F.col("whole") + F.col("_in").cast("long")).cast("int")
    return mixed.select("document", F.explode(F.array_repeat(F.lit(0), times))).select("document.*")
