"""Session helpers: where shared scratch data goes and how a local session is built."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "marketstrata") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Recording a call site for every column expression costs more than small queries do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = context.getConf().get(_CHECKPOINT_DIR) or spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="marketstrata-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/marketstrata/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts the lineage, survives lost executors, and gives the planner true sizes.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
