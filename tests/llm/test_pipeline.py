"""The stages one after another, each against its own definition."""

from collections import Counter

import pytest

import corpus_pipeline
from foldwise.llm.lines import drop_repeated_lines
from foldwise.llm.mixing import mixture
from foldwise.llm.simhash import near_duplicates
from foldwise.sources.scratch import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, documents):
    out = [documents]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "step"))
    return out


def test_columns(steps, documents):
    assert all(s.columns == documents.columns and s.dtypes == documents.dtypes for s in steps[:-1])


def test_clean_documents_stay(steps):
    assert steps[1].count() >= 0.98 * steps[0].count()
    assert steps[1].exceptAll(steps[0]).count() == 0


def test_lines(steps):
    want = {r["doc_id"]: r["text"] for r in drop_repeated_lines(steps[1]).collect()}
    got = steps[2].collect()
    assert {r["doc_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_one_of_each_group(steps):
    want = {r["component_id"] for r in near_duplicates(steps[2]).collect()}
    assert sorted(r["doc_id"] for r in steps[3].collect()) == sorted(want)


def test_mix(steps):
    want = Counter({r["doc_id"]: r["copies"] for r in mixture(steps[3]).collect() if r["copies"]})
    assert Counter(r["doc_id"] for r in steps[4].collect()) == want


def test_every_row_is_packed(steps):
    first = steps[5].filter("piece = 0")
    assert Counter(r["doc_id"] for r in first.collect()) == Counter(r["doc_id"] for r in steps[4].collect())


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == steps[5].count()


def test_awkward_and_no_rows(spark, awkward, nothing):
    for frame in (awkward.withColumn("score", awkward["source"]), nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF), "step")
            assert docs.columns == frame.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
