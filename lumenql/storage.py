"""The folder that the driver and all executors share, and small files in it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver see.

    The cluster names it in ``spark.checkpoint.dir``. Only where neither that nor
    ``SparkContext.setCheckpointDir`` is set and the master is local (tests, notebooks on
    one machine) a local folder is made and set; on a cluster this raises.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder under the master {master}")
        named = tempfile.mkdtemp(prefix="lumenql-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return str(named).rstrip("/")


def hadoop(spark: SparkSession, path: str):
    """A path and its file system, of whatever store holds it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    own = f"{shared_dir(spark)}/lumenql/{spark.sparkContext.applicationId}"
    folder, fs = hadoop(spark, own)
    fs.mkdirs(folder)  # only a path that exists is noted for deletion
    fs.deleteOnExit(folder)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    jvm_path, fs = hadoop(spark, path)
    fs.delete(jvm_path, True)


def put(spark: SparkSession, path: str, data: bytes | str) -> str:
    """Write a small file through the store's own client."""
    jvm_path, fs = hadoop(spark, path)
    stream = fs.create(jvm_path, True)
    stream.write(bytearray(data.encode() if isinstance(data, str) else data))
    stream.close()
    return path
