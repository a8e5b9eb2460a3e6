"""Helpers the text operators share: word patterns, written intermediate tables, numbering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from terraquilt.session import fresh_path

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: computed once, safe against lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove settled tables that nothing unwritten reads any more; others are left alone."""
    for table in tables:
        path = table.__dict__.pop("_settled_at", None)
        if path:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Rows of an Arrow batch between an executor and its workers.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold ``BATCH_ROWS`` rows at most; a smaller setting stays.

    Spark fills 10,000 rows to a batch, outside the heap: with whole texts that is all of a task, in buffers
    that are doubled as they fill and that the executor keeps for later stages.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows: a batch may hold all texts of a task, and a worker should hold them but once.

    What is made of a slice goes back to the executor as a batch of its own, so its buffers stay as small.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_of(column: str | Column) -> Column:
    """The text, a NULL as the empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def count_words(column: str | Column) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str, blocks: int = 256) -> DataFrame:
    """Gapless numbers from 0 within each group, as column ``name``.

    A group is cut into ``blocks`` by the hash of its order columns. Rows are ranked within a
    block and the counts of the blocks before are added, so no task gets a whole group. ``df``
    is read twice: settle it first. Group columns must not be NULL. Equal rows get their
    numbers in either order.
    """
    placed = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    keys = [*group, "_block"]
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        placed.withColumn("_rank", rank)
        .join(offsets, keys)
        .withColumn(name, (F.col("_before") + F.col("_rank") - 1).cast("long"))
        .drop("_block", "_rank", "_before")
    )


#: Equal rows that one task makes out of their number, and rows of a block that are numbered in one.
_REPEATS, _BLOCK_ROWS = 4096, 50_000


def number_equal_rows(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within each group, as column ``name``, where equal rows are a third of all.

    ``df`` is settled and narrow. Equal rows are counted first and are one row with their number while they are
    numbered, in blocks of the hash of their order columns as in ``number_rows``; then each number is a row again,
    a few thousand of one count to a task. The blocks grow with the rows. Group columns must not be NULL.
    """
    columns = df.columns
    distinct = settle(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times")), "numbered-rows")
    rows, most = distinct.agg(F.count(F.lit(1)), F.max("_times")).first()
    blocks = max(256, rows // _BLOCK_ROWS)
    placed = distinct.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    keys = [*group, "_block"]
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys).agg(F.sum("_times").alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys).orderBy(*order, *columns).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_times").over(inside), F.lit(0))
    numbered = placed.join(offsets, keys).select(*columns, "_times", first.alias("_first"))
    if (most or 0) > _REPEATS:
        starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1, F.lit(_REPEATS).cast("long")))
        numbered = numbered.withColumn("_start", starts).repartition("_first", "_start").select(
            *columns, (F.col("_first") + F.col("_start")).alias("_first"), F.least(F.col("_times") - F.col("_start"), F.lit(_REPEATS)).alias("_times")
        )
    return numbered.withColumn(name, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_times") - 1))).select(*columns, name)
