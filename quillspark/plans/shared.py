"""Tables written to the shared folder, to cut lineage in a way that survives the loss of executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of this machine only where that is unset and Spark runs in local mode."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quillspark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return "file://" + folder


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may have ended; the cluster's own clean-up of the folder then takes it
        pass


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it again; deleted at exit."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillspark/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialised(df: DataFrame) -> None:
    """Delete the files of a table that no later step reads."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """For costly work per row: the rows in as many partitions as there are cores, if the scan gives fewer; else unchanged.

    A scan gives a partition for each file at least, and for each split of spark.sql.files.maxPartitionBytes. So what
    is shuffled here is less than that size for each core, and a large table never is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if max(len(df._jdf.inputFiles()), size // split) < cores else df  # the names of files stay in the JVM
