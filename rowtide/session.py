"""Session defaults and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Bytes of input files to a task where rows are dealt out by the size of the input.
TASK_BYTES = 4 << 20


def local_session(app: str = "rowtide", cpus: str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    shuffle = "8" if cpus == "*" else cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session on one machine that names none (tests) gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named is None:
        named = sc.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rowtide-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A folder name never used before, inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder through the file system Spark itself uses; False where there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; empty where there is no such folder. A listing, no Spark job."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the files below a folder, as its file system counts them; 0 where there is none. No Spark job."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def make_mark(spark: SparkSession, path: str) -> None:
    """Create an empty file at once; its name is all it says."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True).close()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_tasks(df: DataFrame) -> int:
    """Tasks that the files ``df`` is read from ask for; 1 where it is read from none (a checkpoint, a batch of a stream)."""
    return max(1, -(-sum(folder_bytes(df.sparkSession, f) for f in df.inputFiles()) // TASK_BYTES))


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """Rows dealt out by ``by`` over a number of tasks that grows with the input, so that what a task holds does not.

    Partitions of a given number are not merged again, and an aggregate, join or window by the same columns needs no other shuffle.
    Rows that lie this way already are not moved.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, input_tasks(df)), *by)


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder so that later steps (and retries) re-read it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(df: DataFrame) -> Column:
    """Rough bytes of a row: text and binary by length, nested values by their JSON, the rest by 8 bytes each."""
    total = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        else:
            total = total + 8
    return total


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after checking rows and bytes; larger frames join by shuffle, with the same result.

    Meant for narrow summary frames that are already pinned, so the check costs one short job.
    """
    few = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if few["n"] <= max_rows and few["b"] <= max_bytes else df
