"""Session construction and the few runtime settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes.  Timestamps are TIMESTAMP_NTZ wall-clock values,
# so results do not depend on the session time zone; UTC is still pinned so
# that any TIMESTAMP input a user passes is read the same way everywhere.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "bazaar", driver_memory: str = "16g",
                extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, build the session as usual and keep
    ``BASE_CONF``; ``spark.checkpoint.dir`` then comes from the cluster."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``; only when the
    session names none (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="bazaar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss, unlike ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_columns(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back: smaller
    than a checkpoint, and later passes read only the columns they use."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/columns-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
