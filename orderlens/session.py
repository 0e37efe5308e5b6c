"""Session settings and the shared checkpoint folder.

Every job in the library assumes a UTC session clock (timestamps are compared as wall-clock
values) and ANSI mode left on (Spark 4's default): divisions and casts that may fail use the
``try_*`` forms instead of switching ANSI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The one setting that results depend on, and those a local session starts with (Spark's own
# defaults; a cluster's choice is left alone).
CLOCK = "spark.sql.session.timeZone"
LOCAL_CONF = {
    CLOCK: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the UTC clock the library depends on (idempotent); nothing else is touched."""
    if spark.conf.get(CLOCK, None) != "UTC":
        spark.conf.set(CLOCK, "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "orderlens") -> SparkSession:
    """A local session for tests, benches and notebooks.

    On a cluster, build the session with the cluster's own settings and call ``configure``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session (tests, benches) without one
    gets a fresh folder of its own; a cluster session without one is an error, because a
    machine-local folder would not be visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    folder = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss, ends the lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
