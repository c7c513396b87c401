"""Stage tables, logs, snapshots and reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators import ordered
from newsloom.sources import shared


def write_stage(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A table that fails to replace another one unless told to."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def append(df: DataFrame, path: str, fresh: bool = False) -> None:
    df.write.mode("overwrite" if fresh else "append").parquet(path)


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and all others, null conditions included."""
    passes = F.coalesce(condition, F.lit(False))
    return df.where(passes), df.where(~passes)


def write_split(df: DataFrame, condition: Column, path: str, overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both sides of a split by one write: rows are classified once, each side is a partition of the table.

    Returns readers of the rows that pass and of all others; a side without rows is an empty table."""
    side = df.withColumn("passes", F.coalesce(condition, F.lit(False)))
    side.write.mode("overwrite" if overwrite else "errorifexists").partitionBy("passes").parquet(path)
    table = df.sparkSession.read.schema(side.schema).parquet(path)
    return table.where("passes").drop("passes"), table.where("NOT passes").drop("passes")


def write_counted(df: DataFrame, path: str, overwrite: bool = False, **metrics: Column) -> DataFrame:
    """Write a stage and count while it is written; one row of the metrics, so that no pass reads it again.

    Metrics are aggregates; they are taken in the tasks that write, each of which counts once."""
    seen = Observation()
    write_stage(df.observe(seen, F.count("*").alias("rows"), *(c.alias(n) for n, c in metrics.items())), path, overwrite)
    got = seen.get
    row = [tuple(got[n] for n in ("rows", *metrics))]
    return df.sparkSession.createDataFrame(row, T.StructType([T.StructField("rows", T.LongType()), *(T.StructField(n, df.select(c).schema[0].dataType) for n, c in metrics.items())]))


def write_snapshot(df: DataFrame, path: str) -> str:
    """A new version beside the older ones, then a pointer row to it; readers never see half of one."""
    spark, version = df.sparkSession, f"{path}/versions/{uuid.uuid4().hex}"
    df.write.parquet(version)
    pointer = spark.createDataFrame([(version,)], "version string").withColumn("written_at", F.current_timestamp())
    pointer.write.mode("append").parquet(f"{path}/pointer")
    return version


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    newest = spark.read.parquet(f"{path}/pointer").agg(F.max_by("version", "written_at").alias("v")).first()["v"]
    return spark.read.parquet(newest)


def write_document(df: DataFrame, path: str) -> None:
    """A summary: rows of nested structs, few enough for one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_digest(head: DataFrame, sections: dict[str, DataFrame], order: Sequence[str], path: str) -> None:
    """A nested document of any size: one row of ``head``, and a folder of JSON lines for each section.

    Sections are sorted by ranges, so the parts in the order of their names are the section in order,
    and no task holds more of it than a range."""
    write_document(head, f"{path}/head")
    for name, rows in sections.items():
        rows.orderBy(*order).write.mode("overwrite").json(f"{path}/{name}")


def read_digest(spark: SparkSession, path: str, head: T.StructType | str, section: T.StructType | str, names: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The head and the sections of a digest, by the schemas they were written with."""
    return spark.read.schema(head).json(f"{path}/head"), {n: spark.read.schema(section).json(f"{path}/{n}") for n in names}


def report_lines(people: DataFrame) -> DataFrame:
    """(section, line_no, line) of (section, subject_name, title, urls); an empty section says None.

    Lines are numbered across ranges of the whole report, and a section's numbers start where it does,
    so a section of any size is no single task's."""
    urls = F.transform(F.coalesce("urls", F.array().cast("array<string>")), lambda u: F.concat(F.lit("    "), u))
    body = F.when(F.col("subject_name").isNull(), F.array(F.lit("- None"))).otherwise(F.concat(F.array(F.concat(F.lit("- "), "subject_name"), F.concat(F.lit("  "), F.coalesce("title", F.lit("(untitled)")))), urls))
    rows = people.select("section", "subject_name", "title", F.posexplode(body).alias("at", "line"))
    rows = ordered.numbered(rows, [F.col(c) for c in ("section", "subject_name", "title", "at", "line")], "__no")
    starts = shared.kept(rows.groupBy(F.col("section").alias("__s")).agg(F.min("__no").alias("__first")), "sections")  # a row a section
    return rows.join(starts, F.col("section").eqNullSafe(F.col("__s"))).select("section", (F.col("__no") - F.col("__first") + 1).alias("line_no"), "line")
