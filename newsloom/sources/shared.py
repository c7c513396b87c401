"""Tables kept between steps, in the folder that all executors share.

``spark.checkpoint.dir`` names that folder.  A written table cuts the lineage and survives lost
executors, and its size on disk is known to the planner.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def base(spark: SparkSession) -> str:
    """The shared folder; a temporary one only in a single process where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{base(spark)}/newsloom/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any path of a glob, is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table whose row groups are read in pieces.

    Vectored reads take a column's part of a row group at once, through a buffer of its size outside the heap that
    the reading thread keeps; executors have little room for these beside their heap."""
    read = spark.read.option("parquet.hadoop.vectored.io.enabled", "false")
    return (read.schema(schema) if schema is not None else read).parquet(path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of it."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return parquet(spark, path, df.schema)
