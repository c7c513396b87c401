"""What Python workers hold between stages of the pipeline."""

import corpus_pipeline
from newsloom.llm import packing
from newsloom.llm import textbatch as tb

SF = "/root/testdata/sf0.001"


def test_tasks_before_packing_drop_the_tokenizer(spark, monkeypatch):
    """Each batch function of the first four stages empties its worker, so a run does not start beside the tokenizer of the run before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *rest, **more: (made.append(f), real(self, f, *rest, **more))[1])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = len(made)
        stage(spark, docs, SF)
        assert name == "line dedup" or len(made) > before
    for f in made:
        monkeypatch.setitem(tb._resident, "tokenizer", object())
        list(f(iter(())))
        assert not tb._resident, f


def test_memory_is_given_back_and_notes_stay(monkeypatch):
    monkeypatch.setitem(tb._resident, "tokenizer", 1)
    assert list(tb.trimmed(lambda batches: (2 * x for x in batches))([1, 2])) == [2, 4] and tb._resident == {"tokenizer": 1}


def test_the_plan_of_packing_starts_no_python_workers(spark, capsys):
    """A list as a table goes through Python workers of their own, beside those of the operators."""
    import public_tokenizers

    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    for some in (docs, docs.where("doc_id > 2")):
        packing.pack(some, public_tokenizers.path(packing.VOCABULARY)).explain()
        assert "ExistingRDD" not in capsys.readouterr().out
