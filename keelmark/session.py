"""Session defaults and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "keelmark", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches. On a cluster, spark-submit supplies the sizes."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of data, to be passed to spark-submit.

    Shuffles start with partitions of about 128 MB and are merged at run time where
    less arrives; partitions far above the median are split in joins.
    """
    partitions = 1 + input_bytes // (128 * 1024**2)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def use_utc(spark: SparkSession) -> None:
    """Sources carry zone-less timestamps in UTC; anything that does consult the session zone should agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="keelmark-"))
    return context.getCheckpointDir()


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
