"""The pipeline, stage by stage, against plain Python versions."""

import brute
import corpus_pipeline
import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from tallyframe.llm.oracles import ORACLES
from tallyframe.llm.queries import QUERIES
from tallyframe.llm.base import saved


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, docs, name):
    assert differences(QUERIES[name](spark, "/root/testdata/sf0.001"), duck("/root/testdata/sf0.001"), ORACLES[name]) == []


def test_registered():
    assert {"pipeline", *QUERIES} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_stages(spark, docs):
    frame, before = docs, None
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, saved(stage(spark, frame, "/root/testdata/sf0.001"), name)
        if name != "packing":
            assert frame.dtypes == docs.dtypes
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        if name == "quality_rules":
            left = {r["doc_id"] for r in frame.collect()}
            assert left <= {i for i, t in rows if not brute.quality(t)[-1]} and len(left) > 0.6 * len(rows)
        if name == "line_dedup":
            want = brute.line_dedup(rows)
            assert {r["doc_id"]: r["text"] for r in frame.collect()} == {i: w[2] for i, w in want.items()}
            assert frame.where("n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            want = brute.near_components(rows, 5, 80)
            assert {r["doc_id"] for r in frame.collect()} == {i for i, (_, c) in want.items() if i == c}
        if name == "mix_sources":
            taken, size = sum(len(brute.words(r["text"])) for r in frame.collect()), sum(len(brute.words(t)) for _, t in rows)
            assert taken == pytest.approx(1.5 * size, rel=0.2)
        if name == "packing":
            assert frame.where("start = 0").count() == len(rows)


def test_pipeline_on_nothing(spark, docs):
    frame = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        frame = saved(stage(spark, frame, ""), name)
        assert frame.count() == 0
