"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again
as the next one's ``docs``.  All but the last return the columns of ``documents``, with no others
in their way: columns that an operator adds are dropped, and names that it needs are its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontam, lines, packing, scratch, setjoin, toxicity
from newsloom.operators import ordered


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; those without words have the score of the prior alone and are judged by it like others.

    Rows with a null id are scored and take no part in training; rows that repeat an id are judged each by its text."""
    model, calibration = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, model, calibration, ordinary_only=True).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in one document; ``n_chars`` follows the text.

    Rows with a null id stay as they are; a null text stays null; a document may end up without text and stays."""
    out = lines.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays; null ids come last, and of rows with one id the least text's is first.

    Links are between rows: where ids repeat or are null, rows are numbered in that order first, so
    that another text of a copy's id stays and a repeated row goes.  Documents without words are
    linked with nothing and all stay; an empty table stays empty."""
    key, rows = "doc_id", docs
    repeats = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if repeats.take(1):
        key = "__row"
        rows = ordered.numbered(docs, [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.xxhash64(F.lit(1), "text")], key)
    found = setjoin.similar_documents(rows, id_col=key)
    copies = scratch.table(found.where(F.col("component_id") != F.col(key)).select(F.col(key).alias("__copy")), "copies")
    return rows.join(copies, F.col(key) == F.col("__copy"), "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go; without a benchmark, or without words, they stay."""
    return decontam.judge_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), clean_only=True).select(docs.columns)


#: Words that a tokenizing worker notes: fewer than by default, as executors still hold memory of the stages before.
MEMO = 100_000


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048; a text that is null or empty is one piece with the end token."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY), memo=MEMO)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Language models and tokenizers are beyond SQL; the tests hold a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if at:
            scratch.discard(before)  # the kept rows are written, nothing reads it again
    return STAGES[-1][1](spark, docs, sf_dir)
