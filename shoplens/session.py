"""Session helpers: building a session for tests/bench and finding the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "shoplens") -> SparkSession:
    """A session for local runs (tests, bench). Clusters bring their own session."""
    master = master or os.environ.get("SHOPLENS_MASTER", "local[*]")
    cores = os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SHOPLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where the session has none.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only a
    local-mode session without that setting (tests) gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shoplens-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table (zstd) under the shared checkpoint folder and read it
    back: lineage is cut, a lost executor re-reads files instead of recomputing, and later
    scans get column pruning and filter pushdown."""
    import uuid

    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/shoplens-{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").options(**({"compression": "zstd"} | (options or {}))).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
