"""Shared folder, table reading and sizing helpers of the pipeline operators."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one Python group or bucket is planned to hold.
CHUNK_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir, or a folder of our own where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/vellum/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def remove_written(df: DataFrame) -> None:
    """Delete the files behind a frame made by written()."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        remove_path(df.sparkSession, f)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Total UTF-8 bytes of a text column."""
    row = docs.agg(F.sum(F.octet_length(column)).alias("b")).first()
    return int(row["b"] or 0)


def parts_for(total_bytes: int, chunk: int = CHUNK_BYTES) -> int:
    return max(1, math.ceil(total_bytes / chunk))


def set_python_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows: documents may be very long, so rows, not bytes, are what the setting can bound."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
