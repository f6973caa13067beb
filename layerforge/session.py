"""Session settings the loads rely on, and the folder used to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution coalesces small shuffle partitions, splits skewed ones and
# re-plans to broadcast joins from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, checkpoint: str | None = None
) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own.

    ``checkpoint`` names the folder that takes the role of the shared one.
    """
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("layerforge")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if checkpoint is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="layerforge-checkpoint-"))
        current = sc.getCheckpointDir()
    return current


# Of the files that loads write: they are written and read more often than computed.
CODEC = "zstd"


# Bytes of rows that Spark's size check before a broadcast takes a byte of these files for.
# Sorted keys take a tenth of their rows here: a file under the limit may be far above it
# as rows, which the driver holds several times over.
FILE_FACTOR = 8.0


def count_rows_of_files(spark: SparkSession) -> None:
    """Let the size check before a broadcast go by the size of rows, not of compressed files.

    What is small as rows is still broadcast, once its shuffle has told so. A session
    that brings a factor keeps it.
    """
    name = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(name)) == 1.0:
        spark.conf.set(name, str(FILE_FACTOR))


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files and checkpoints of plans that are done.

    Spark deletes them when the driver collects its garbage, which a driver with
    much memory may not do before the disks are full.
    """
    gc.collect()
    spark._jvm.System.gc()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder; deleted when the session's JVM ends."""
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder; survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_once(df: DataFrame) -> DataFrame:
    """``df`` written to files of its own in the shared folder, for plans that read it several times.

    Compressed and in columns, unlike a checkpoint: a plan reads the columns it needs.
    """
    path = shared_folder(df.sparkSession, "rows")
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)
