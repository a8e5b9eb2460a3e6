"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 2**20


def build_session(app: str = "terraquilt", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators count on (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # call-site capture costs a JVM round trip per column operation
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder of this machine, which is removed at the end.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="terraquilt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """New, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def settled(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Written to the shared folder and read back: compressed, and of later reads each takes its own columns only.

    ``file_rows``: a task that writes more rows than these starts another file; no limit by default.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(settled: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a settled, narrow table's counted rows and the bytes of its texts allow to broadcast it."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in settled.dtypes if kind in ("string", "binary")]
    width = sum(texts, F.lit(16 * len(settled.columns)))
    rows, size = settled.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows <= limit and size <= MAX_BROADCAST_BYTES


def broadcast_if_small(table: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Settle a narrow aggregate and broadcast it if its counted rows and the bytes of its texts allow.

    Spark estimates an aggregate by the size of its input, so a join with one row per raster
    would be planned as a shuffle of all pixels. The aggregate is checkpointed, hence computed
    once, and then counted; beyond the limit the join stays an ordinary one.
    """
    settled = cut_lineage(table)
    return F.broadcast(settled) if fits_broadcast(settled, limit) else settled


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few literal rows as a local relation, whose size the planner knows."""
    names = ", ".join(part.strip().split(" ")[0] for part in ddl.split(","))
    values = ", ".join(
        "(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else repr(v) for v in row) + ")"
        for row in rows
    )
    casts = [f"CAST({p.strip().split(' ')[0]} AS {p.strip().split(' ')[1]})" for p in ddl.split(",")]
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})").selectExpr(
        *[f"{cast} AS {name}" for cast, name in zip(casts, names.split(", "))]
    )
