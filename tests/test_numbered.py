"""Rows numbered across ranges, batches of them, and keyless rows that stay out of windows."""

from pyspark.sql import functions as F

from newsloom.operators import ordered


def test_numbers_follow_the_whole_order(spark):
    rows = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("x"), F.lit("a").alias("position")).repartition(7)
    got = ordered.numbered(rows.drop("position"), [F.col("x").desc()]).collect()
    want = {x: i + 1 for i, x in enumerate(sorted((r["x"] for r in got), reverse=True))}
    assert len(got) == 5000 and all(want[r["x"]] == r["position"] for r in got)


def test_batches_are_in_order(spark):
    got = {r["id"]: r["batch"] for r in ordered.batches(spark.range(23).repartition(5), [F.col("id")], 10).collect()}
    assert got == {i: i // 10 + 1 for i in range(23)}
    assert ordered.batches(spark.range(0), [F.col("id")], 10).count() == 0


def test_keyless_rows_spread_and_stay(spark):
    rows = spark.createDataFrame([(None if i % 3 == 0 else str(i % 3), i) for i in range(300)] + [("", 300), ("0", 301), ("", 302)], "k string, seq int")
    assert ordered.first_wins(rows, "k", ["seq"]).where("k IS NULL").count() == 100
    kept = ordered.dedupe_known(rows.withColumn("e", F.lit(1)), ["e"], "k", ["seq"])
    assert kept.where("coalesce(k, '') IN ('', '0')").count() == 103 and kept.where("k IN ('1', '2')").count() == 2
    assert sorted(kept.columns) == ["e", "k", "seq"]


def test_no_score_is_no_class_of_its_own(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, -1), (1, 3, 2), (2, 1, None), (2, 2, 0)], "e int, rank int, score int")
    assert sorted((r["e"], r["rank"]) for r in ordered.select_candidates(rows, ["e"]).collect()) == [(1, 1), (1, 3), (2, 1)]
