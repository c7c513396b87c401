"""Tables between two steps, in the folder that all executors share.

``spark.checkpoint.dir`` names that folder.  A written table cuts the lineage, survives lost
executors, and its size on disk is known to the planner, so a join with it is broadcast only
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.sources import shared


def base(spark: SparkSession) -> str:
    return shared.base(spark)


def new_path(spark: SparkSession, name: str) -> str:
    return shared.folder(spark, name)


def given(spark: SparkSession, path: str) -> DataFrame:
    """A reader of a given table."""
    return shared.parquet(spark, path)


def table(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once and return a reader of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return shared.parquet(spark, path, df.schema)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``table`` that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark._jvm
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/newsloom/" in f}
        for folder in folders:
            at = jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
