"""Session settings and the shared folder that iterative jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Rows and bytes of one Arrow batch.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job of this package relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "tagtide") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which every executor can reach.

    ``spark.checkpoint.dir`` is required on a cluster: a folder of one machine would be
    lost with it. A session whose executors are threads of the driver gets a temporary one.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tagtide-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The table survives the loss of executors, and its known size lets Catalyst
    choose the join of the next round anew. ``replaces`` is a table of an earlier round, made
    here too, that nothing reads any more: it is deleted once the new one is complete.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    if replaces is not None and hasattr(replaces, "scratch_path"):
        delete_folder(spark, replaces.scratch_path)
    return table


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds, in whatever file system it is. False if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it is not there."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    return [f.getPath().getName() for f in files.listStatus(top) if f.isDirectory()]


def is_file(spark: SparkSession, path: str) -> bool:
    """True if there is something at ``path``, in whatever file system it is."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables that jobs of this session have written for themselves. Returns their number.

    Results that were not stored elsewhere read from them: call it between jobs.
    """
    names = [name for name in folders(spark, shared_dir(spark)) if name.startswith("table-")]
    for name in names:
        delete_folder(spark, f"{shared_dir(spark)}/{name}")
    return len(names)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session are bounded in rows and bytes from here on: a text may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def pin(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``. Its partitioning is kept, so joins on that key need no shuffle."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
