"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

All native: paragraphs are split, counted and scored by SQL functions and the JVM's logistic
regression.  A paragraph is a run of lines without a blank one.  It is judged in units: windows
of ``UNIT`` words every ``STEP`` words over its joined lines, so that a notice as long as the
longest template lies whole in one window however it is wrapped, and each of its lines alone.

Training rows are the templates below with words left out in turn, alone and set into units of
ordinary text, against ordinary units: a bounded sample of the corpus (about ``MAX_ORDINARY``
rows by hash, units from anywhere in the text) and sentences with legal words.  Features are
hashed word unigrams and bigrams.  The unknown class is calibrated: a family needs a probability
above the highest that held-out ordinary units reach, and above 0.5.  A prediction stands only
if the unit also holds most of the template's word pairs.

Each template has a few words without which a unit cannot hold enough of its pairs; paragraphs
and units whose lower-case text contains none of them are left out before the model.  That
changes no result: a word of a unit is a part of its text.

Defined results: null and empty texts have no paragraphs and no licence; the licences of a row
depend on its text alone, so rows that repeat an id, or have none, are judged each by its own
text; of templates or families with equal probability the first listed is taken; long texts are
read whole; other input columns pass through, those named like the results are replaced; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import scratch
from newsloom.sources import readers

#: Sentences of public licence notices by family.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-3.0", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license version 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "copyright all rights reserved no part of this publication may be reproduced"),
)
#: Sentences with words of licences that license nothing.
ORDINARY = (
    "the driver had to renew a license after the test",
    "the right of all people is reserved for the court",
    "free software meets in the public library this week",
    "all seats reserved for guests of the general",
    "this work was done under the terms of the old version",
    "the apache people of the south",
    "a copy of the book is at the library",
    "version 3 of the game is free of charge",
    "the court held that the license was granted subject to conditions that were not met",
    "the parties agree that any use of the name of the holder without permission is a breach of this contract",
    "the author has waived the fee for the public reading of the work",
    "redistribution of land in the following conditions was permitted by law",
    "the holder of a fishing license may not sell the fish that are caught under it",
    "permission to build was granted by the council free of charge to any person who asked",
)
FAMILIES = tuple(dict.fromkeys(f for f, _ in TEMPLATES))
#: Rows of the corpus that the model's ordinary class is fitted on, about.
MAX_ORDINARY = 1_000
FEATURES, CONFIRM = 1 << 11, 0.6
STEP = 2 + max(len(t.split()) for _, t in TEMPLATES)
UNIT = 2 * STEP
RESULTS = ("licences", "n_licence_paragraphs", "licence_score")


def _words(text: Column) -> Column:
    """Lower-case words; dots stay inside numbers, hyphens and other marks part words."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\p{N})", " "), " +"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(F.get(words, i), F.lit(" "), w))


def _vectors(rows: DataFrame) -> DataFrame:
    """Hashed unigrams and bigrams of ``words``, as one sparse vector."""
    rows = NGram(n=2, inputCol="words", outputCol="__two").transform(rows)
    rows = HashingTF(numFeatures=FEATURES, binary=True, inputCol="words", outputCol="__a").transform(rows)
    rows = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__two", outputCol="__b").transform(rows)
    return VectorAssembler(inputCols=["__a", "__b"], outputCol="features").transform(rows).drop("__two", "__a", "__b")


def _templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(FAMILIES.index(f), f, t) for f, t in TEMPLATES], "class int, family string, text string")
    return rows.withColumn("words", _words(F.col("text")))


def _cues() -> str:
    """Words without which no template keeps a share of CONFIRM of its distinct pairs, longest first."""
    cues: set[str] = set()
    for _, text in TEMPLATES:
        words = text.split()
        pairs, chosen = set(zip(words, words[1:], strict=False)), set()
        for word in sorted(set(words), key=lambda w: (-len(w), w)):
            if sum(not chosen & set(p) for p in pairs) < CONFIRM * len(pairs):
                break
            chosen.add(word)
        cues |= chosen
    return "|".join(sorted(w.replace(".", r"\.") for w in cues))


def _all_units(block: Column, words: Column) -> Column:
    """Windows of a paragraph's words, and its lines of up to UNIT words if it has several."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - STEP - 1), F.lit(STEP))
    windows = F.transform(starts, lambda s: F.slice(words, s + 1, F.lit(UNIT)))
    lines = F.filter(F.transform(F.split(block, "\n"), _words), lambda w: F.size(w).between(2, UNIT))
    return F.when(F.contains(block, F.lit("\n")), F.concat(windows, lines)).otherwise(windows)


def units(docs: DataFrame, text_col: str, with_cue: bool = True) -> DataFrame:
    """(key, number, words): units by digest of the text and number of the paragraph; ``with_cue`` keeps those that can be confirmed."""
    kept = docs.where(F.lower(text_col).rlike(_cues())) if with_cue else docs
    rows = kept.select(F.md5(F.col(text_col).cast("binary")).alias("key"), F.posexplode(F.split(text_col, r"\n\s*\n")).alias("number", "block"))
    rows = rows.where(F.lower("block").rlike(_cues())) if with_cue else rows
    rows = rows.withColumn("words", _words(F.col("block"))).select("key", "number", F.explode(_all_units(F.col("block"), F.col("words"))).alias("words"))
    return rows.where(F.array_join("words", " ").rlike(_cues())) if with_cue else rows.where(F.size("words") > 1)


def _confirmed(rows: DataFrame) -> DataFrame:
    """``rows`` with the templates of their ``class`` of whose pairs they hold a share of CONFIRM."""
    pairs = _templates(rows.sparkSession).select("class", "family", F.array_distinct(_pairs(F.col("words"))).alias("pairs"))
    share = F.size(F.array_intersect("pairs", _pairs(F.col("words")))) / F.size("pairs")
    return rows.join(F.broadcast(pairs), "class").where(share >= CONFIRM)  # as many rows as TEMPLATES


def _ordinary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Words of units of about MAX_ORDINARY rows, two a row, from anywhere in the text; none that a template confirms."""
    texts = docs.where(F.col(text_col).isNotNull())
    share = MAX_ORDINARY / max(1, texts.count())
    chance = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30))
    rows = texts.where(chance < int(min(1.0, share) * (1 << 30))).orderBy(chance, F.md5(text_col)).limit(2 * MAX_ORDINARY).select(text_col)
    found = units(rows, text_col, with_cue=False).groupBy("key").agg(F.min_by("words", F.xxhash64("words")).alias("a"), F.max_by("words", F.xxhash64("words")).alias("b"))
    found = found.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("words"))
    near = F.lit(False)
    for _, text in TEMPLATES:
        words = text.split()
        pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
        near = near | (F.size(F.array_intersect(F.array(*map(F.lit, pairs)), _pairs(F.col("words")))) >= CONFIRM * len(pairs))
    return found.where(~near)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[LogisticRegressionModel, float]:
    """The model and the probability that a family has to pass."""
    spark = docs.sparkSession
    known = _templates(spark).select("class", "words")
    variants = known.select("class", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("out")).select("class", F.filter("words", lambda w, i: i != F.col("out")).alias("words"))
    variants = variants.join(known.select(F.col("class").alias("__other"), "words"), "words", "left").where("__other IS NULL OR __other = class").select("class", "words")  # what is another family's notice in full
    odd = spark.createDataFrame([(t,) for t in ORDINARY], "text string").select(_words(F.col("text")).alias("words"))
    held = F.pmod(F.xxhash64(F.array_join("words", " ")), F.lit(4)) == 0
    plain = scratch.table(_ordinary(docs, id_col, text_col).unionByName(odd).withColumn("held", held), "ordinary-units")
    # a few variants meet an ordinary unit of the same bucket and are set into its middle
    bucket = F.pmod(F.xxhash64("words"), F.lit(256))
    around = plain.where(~F.col("held")).select(bucket.alias("bucket"), F.col("words").alias("context"))
    half = F.floor(F.least(F.size("context"), F.lit(UNIT) - F.size("words")) / 2).cast("int")
    inside = variants.withColumn("bucket", bucket).join(around, "bucket").select("class", F.concat(F.slice("context", F.lit(1), half), F.col("words"), F.slice("context", half + 1, half)).alias("words"))
    rows = variants.unionByName(inside).withColumn("held", F.lit(False)).unionByName(plain.withColumn("class", F.lit(len(FAMILIES))))
    rows = _vectors(scratch.table(rows.withColumn("class", F.col("class").cast("double")), "licence-rows").coalesce(2)).cache()  # recomputed from a table if lost
    model = LogisticRegression(featuresCol="features", labelCol="class", family="multinomial", regParam=1e-3, maxIter=30).fit(rows.where(~F.col("held")))
    top = F.array_max(F.slice(vector_to_array("probability"), 1, len(FAMILIES)))
    bar = model.transform(rows.where(F.col("held"))).agg(F.coalesce(F.max(top), F.lit(0.0)).alias("bar")).first()["bar"]
    rows.unpersist()
    return model, max(0.5, bar)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trained: tuple[LogisticRegressionModel, float] | None = None) -> DataFrame:
    """``docs`` with ``licences`` (confirmed families, sorted), ``n_licence_paragraphs`` and ``licence_score``; trained on ``docs`` unless given."""
    docs = docs.drop(*RESULTS)
    model, bar = trained or train(docs, id_col, text_col)
    scored = model.transform(_vectors(units(docs, text_col)))
    chances = F.slice(vector_to_array("probability"), 1, len(FAMILIES))
    scored = scored.select("key", "number", "words", F.array_max(chances).alias("score"), (F.array_position(chances, F.array_max(chances)) - 1).cast("int").alias("class"))
    confirmed = _confirmed(scored.where(F.col("score") > bar))
    found = confirmed.groupBy("key").agg(F.array_sort(F.collect_set("family")).alias("licences"), F.countDistinct("number").alias("n_licence_paragraphs"), F.max("score").alias("licence_score"))
    found = found.withColumnRenamed("key", "__key")
    # the digest as a column, so that the shuffle carries texts only if they are read later
    out = docs.withColumn("__digest", F.md5(F.col(text_col).cast("binary"))).join(found, F.col("__digest") == F.col("__key"), "left").drop("__digest", "__key")
    return out.withColumn("licences", F.coalesce("licences", F.array().cast("array<string>"))).withColumn("n_licence_paragraphs", F.coalesce("n_licence_paragraphs", F.lit(0)))


def op2_licence_scan(spark, sf_dir: str) -> DataFrame:
    out = scan_licences(readers.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    return out.select("doc_id", F.array_join("licences", ",").alias("licences"), "n_licence_paragraphs", F.round("licence_score", 4).alias("licence_score"))
