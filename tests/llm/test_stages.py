"""Every pipeline stage on odd rows: nulls, empty texts, repeats, clashing columns, an empty table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLEAN = "The weather in the valley was calm and the people of the village went out to the market, where they bought bread and cheese for the week.\n" * 2
OTHER = "A second text speaks about ships at sea, their crews, the storms they met on the way and the harbours that they reached in the end."


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(1, CLEAN), (2, None), (3, ""), (4, OTHER), (4, OTHER), (None, OTHER + " more"), (6, "\n \n"), (7, "x")]
    return spark.createDataFrame([(k, t, "en", None, None) for k, t in rows], SCHEMA).withColumns({n: F.lit(1) for n in ("key", "row", "_k", "digest", "_found")})


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, odd_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd_docs, FOLDER).collect()
    kept = {r["doc_id"] for r in out}
    if name == "byte-level BPE":
        assert len(out) == 8 and {r["n_tokens"] for r in out if r["doc_id"] in (2, 3)} == {0}
    else:
        assert set(out[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}
    if name == "line dedup":
        assert kept == {None, 1, 2, 3, 4, 6, 7} and len(next(r["text"] for r in out if r["doc_id"] == 1).strip("\n").split("\n")) == 1
    if name == "MinHash near-dedup":
        assert sorted(kept - {None}) == [1, 2, 4, 6, 7] and len(out) in (5, 6)
    if name == "benchmark decontamination":
        assert len(out) == 8
    empty = stage(spark, odd_docs.limit(0), FOLDER)
    assert empty.count() == 0


@pytest.mark.parametrize("name", ["benchmark decontamination", "byte-level BPE"])
def test_a_task_needs_one_worker_at_a_time(spark, odd_docs, name):
    """Executors keep the workers that their tasks have used at once. Before, three Python steps ran in one task, and two in another."""
    plan = dict(corpus_pipeline.STAGES)[name](spark, odd_docs, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert sum(plan.count(node) for node in ("ArrowEvalPython", "FlatMapCoGroupsInArrow", "MapInArrow")) == 1, plan
