"""Terms that some of the texts rule out are not counted in all of them, and a task adds up what it counts."""

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import pii, scratch


def test_common_words_are_ruled_out_before_all_texts_are_counted(spark, monkeypatch):
    word = lambda i, j: f"w{i}x{j}"
    texts = [f"common {' '.join(word(i, j) for j in range(8))}" + (f" secretword mail a{i}@house.example" if i < 8 else "") for i in range(800)]
    asked = []
    count = pii._term_texts

    def counted(docs, *rest):
        asked.append(next(x for x in rest[::-1] if hasattr(x, "columns") and x.columns == ["term"]).count())
        return count(docs, *rest)

    monkeypatch.setattr(pii, "_term_texts", counted)
    told = pii.telling_terms(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert len(told) == 2  # secretword and mail
    assert asked == [3, 2]  # the common word is ruled out by an eighth of the texts


def test_a_task_makes_one_row_of_a_term(spark, monkeypatch):
    """Two tasks of several slices each; before, every slice left a row of each term."""
    texts = [(f"common own{i} " + " ".join(f"filler{i}x{j}" for j in range(400)),) for i in range(1200)]
    docs = spark.createDataFrame(texts, "text string").repartition(2)
    hashes = [int(pii._Terms(*_slice(word)).hash[0]) for word in ("common", "own7")]
    kept, table = [], scratch.table
    monkeypatch.setattr(scratch, "table", lambda df, name, *rest: (kept.append((name, out := table(df, name, *rest))), out)[1])
    copies = spark.sparkContext.broadcast(pii._bitmap(table(spark.createDataFrame([], "a long"), "none")))
    found = pii._term_texts(docs, copies, spark.createDataFrame([], "a long"), spark.createDataFrame([(h,) for h in hashes], "term long"), "text")
    assert {r["term"]: r["n"] for r in found.where(F.col("term").isin(hashes)).collect()} == {hashes[0]: 1200, hashes[1]: 1}
    rows = dict(kept)["term-texts"].where(F.col("term") == hashes[0])
    assert rows.count() == 2  # a task each


def _slice(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])
