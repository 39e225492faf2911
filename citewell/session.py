"""Session settings, the shared stage folder, and input spreading."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Spark's setting that removes the shuffle files of an execution when it has ended.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# One shuffle partition should hold about this much.
_PARTITION_BYTES = 128 * 1024 * 1024


def partition_settings(input_bytes: int) -> dict[str, str]:
    """Shuffle settings for jobs over ``input_bytes``.

    Shuffles start with one partition per 128 MB of input, so that none outgrows an
    executor; adaptive execution merges the small ones that map-side combining leaves.
    """
    partitions = max(200, -(-input_bytes // _PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * _PARTITION_BYTES),
    }


def build_session(
    app_name: str = "citewell", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with adaptive execution; keyword settings write a dot as ``__``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in (partition_settings(input_bytes) if input_bytes else {}).items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    Taken from ``spark.checkpoint.dir``.  Only a local master may fall back to a
    temporary folder: on a cluster that folder would not be visible to executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="citewell-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint; rows and partitions are then fixed."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def _shuffles_released(spark: SparkSession):
    """Shuffle files of what is executed here go when it has ended, not when the driver happens to collect its garbage.

    An execution of another thread that falls into this time loses its files, too, when it has ended; it makes them
    again should it be asked once more.
    """
    before = spark.conf.get(_RELEASE, "false")
    if before == "true":
        yield
        return
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet stage table in the shared folder and read it back.

    Used where several later jobs read one expensive intermediate: the table
    survives executor loss, and readers still get column pruning.  Nothing reads the
    shuffles behind it again, so their files are released once it is written.
    """
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    with _shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Remove stage tables that nothing reads again, just as ``staged`` gave them."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a narrow input whose files give fewer splits than there are cores.

    Large inputs already have more splits than cores and pass through unshuffled.
    """
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= parallelism:
        return df
    return df.repartition(parallelism, key)
