"""Empty tables, empty files, null and repeated ids: each operator and stage has a defined result."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import decontam, scratch, warc
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string, component_id long"
NEAR = " ".join(f"w{i}" for i in range(200))


def test_archive_of_nothing_and_empty_first_file(spark, tmp_path):
    page = "page_id long, url string, html string"
    path = scratch.new_path(spark, "warc-empty")
    warc.write_archive(spark.createDataFrame([], page), path)
    assert warc.read_archive(spark, path).count() == 0
    warc.write_archive(spark.createDataFrame([(1, "u", "x")], page), f"file://{tmp_path}/a", compression="none")
    (tmp_path / "a" / "00-empty.warc").write_bytes(b"")
    assert [r["record_id"] for r in warc.read_archive(spark, f"file://{tmp_path}/a").collect()] == ["1"]


def test_null_ids_are_judged_both_ways(spark):
    item = " ".join(f"b{i}" for i in range(30))
    rows = [(None, item), (None, "clean words"), (1, item), (1, "other clean words"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame([(0, item)], "item_id long, text string")
    for limit in (decontam.MAX_ITEM_BYTES, 0):
        got = sorted((r["n_words"], r["n_hit"], r["contaminated"]) for r in decontam.judge_contamination(docs, items, max_item_bytes=limit).collect())
        assert got == [(0, 0, False), (2, 0, False), (3, 0, False), (30, 30, True), (30, 30, True)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "clash", 7) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(0, " ".join(f"b{i}" for i in range(20)))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_near_copies_go_by_text_where_ids_repeat(spark, tables):
    other = " ".join(f"v{i}" for i in range(200))
    rows = [(1, NEAR), (2, NEAR + " end"), (2, other), (3, other), (3, other), (None, NEAR), (None, "own words of a row without an id"), (5, None), (5, None), (6, "")]
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, rows), tables)
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, NEAR), (2, other), (None, "own words of a row without an id"), (5, None), (5, None), (6, "")], key=repr)
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, [(4, NEAR), (3, NEAR), (9, other)]), tables)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 9]


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "a"), (1, None), (1, ""), (2, "x " * 20_000), (3, "line of some length\nline of some length"), (3, "line of some length"), (4, " ".join(f"B{i}" for i in range(20)))]])
def test_stages_on_edge_rows(spark, tables, rows):
    docs = frame(spark, rows)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, tables)
        if name != "best-fit packing":
            assert got.columns == docs.columns
        out[name] = got.collect()
    if not rows:
        assert not any(out.values())
        return
    assert len(out["toxicity"]) == len(out["line dedup"]) == len(rows)
    assert sorted(r["text"] for r in out["line dedup"] if r["doc_id"] == 3) == ["line of some length", "line of some length\nline of some length"]
    assert {r["doc_id"] for r in out["benchmark decontamination"]} == {None, 1, 2, 3}
    assert len({(r["doc_id"], r["piece"]) for r in out["best-fit packing"]}) >= 4


def test_whole_pipeline_against_plain_stages(spark, tmp_path):
    """``run`` on a small corpus: planted toxic, repeated, near and contaminated rows go, clean rows stay."""
    at = str(tmp_path)
    item = " ".join(f"b{i}" for i in range(20))
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re") for b in ("ta", "vo", "si", "du", "pe", "xo")]
    text = lambda i: " ".join(f"{vocabulary[(i * 7 + k * k) % 30]}{(i * 31 + k) % 97 if k % 3 == 0 else ''}" for k in range(60))
    rows = [(i, text(i) if i % 4 else "zzidiot zzscum zzloser " * 4 + text(i)) for i in range(400)]
    rows += [(1001, text(1) + " more"), (1002, text(2)), (1003, item), (1004, text(5) + "\na line that two documents hold"), (1005, text(2000) + "\nA line that two documents hold ")]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, at).collect()
    kept = {r["doc_id"] for r in packed}
    left = {1002: "", 1004: "a line that two documents hold", 1005: text(2000)}  # lines that smaller ids hold go first
    components = brute.components([(i, left.get(i, t)) for i, t in rows if i % 4 or i >= 400])
    want = {i for i, (_, c) in components.items() if c == i} - {1003}
    assert kept == want and 1001 not in kept and {1002, 1004, 1005} <= kept
    assert os.path.isdir(f"{at}/documents.parquet") and spark.read.parquet(f"{at}/documents.parquet").where(F.col("doc_id") == 1005).count() == 1


def test_kept_tables_are_read_without_buffers_of_row_groups(spark):
    """Buffers outside the heap that readers keep don't have a row group's size."""
    wide = spark.range(0, 4_000_000, 1, 1).select(*(F.rand(i).alias(f"c{i}") for i in range(3)))  # 32 MB a column, one row group
    table = scratch.table(wide, "wide")
    beans = spark._jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(spark._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
    direct = next(b for b in beans if b.getName() == "direct")
    before = direct.getTotalCapacity()
    table.agg(*(F.sum(c) for c in table.columns)).collect()
    assert direct.getTotalCapacity() - before < 30_000_000
