"""Each stage on its own input, against brute force, and the whole run."""

import numpy as np
import pytest

import corpus_pipeline
from gapmend.shared import folder_names, fresh_path, shared_dir
from tests.llm.cases import contaminated, documents, later_lines, linked, odd_documents, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of each stage, the documents first."""
    rows = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, name)
        stage(spark, rows[-1], SF).write.parquet(path)
        rows.append(spark.read.parquet(path))
    return rows


def test_stages_are_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_all_but_the_last_return_documents(stages):
    for rows in stages[1:-1]:
        assert rows.dtypes == stages[0].dtypes


def test_known_languages_stay(stages):
    assert sorted(map(tuple, stages[1].collect())) == sorted(map(tuple, stages[0].collect()))


def test_later_lines_go(stages):
    rows = [(r.doc_id, r.text, 0) for r in stages[1].collect()]
    want = {r[0]: v[2] for r, v in later_lines(rows, 1).items()}
    got = {r.doc_id: r for r in stages[2].collect()}
    assert {i: r.text for i, r in got.items()} == want and want != {r[0]: r[1] for r in rows}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_one_of_each_group_stays(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    parts = linked([simhash(t) for _, t in rows], 4)
    first = {}
    for (i, _), p in zip(rows, parts):
        first.setdefault(p, i)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(first.values())
    assert len(first) < len(rows)


def test_benchmark_documents_go(spark, stages):
    rows = [(r.doc_id, r.text) for r in stages[3].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = contaminated([t for _, t in rows], items)
    clean = [i for (i, _), (n, hit, _) in zip(rows, judged) if not (hit and 20 * hit >= n)]
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(clean)


def test_run_is_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == stages[-1].columns
    tokens = {r.doc_id: r.doc_tokens for r in whole.collect()}
    assert tokens == {r.doc_id: r.doc_tokens for r in stages[-1].collect()} and columns[0] == "doc_id"
    assert set(tokens) == {r.doc_id for r in stages[4].collect()}
    assert np.isclose(sum(r.length for r in whole.collect()), sum(tokens.values()))


def test_stages_on_odd_documents(spark):
    rows = odd_documents(spark)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, SF)
        if i < 4:
            assert out.columns == rows.columns
        path = fresh_path(spark, name)
        out.write.parquet(path)
        found = spark.read.parquet(path)
        if name == "near_dedup":
            kept = [tuple(r) for r in found.select("doc_id", "text").collect()]
            assert len(kept) == len(set(kept)) < rows.count()
        if i == 1:
            assert found.count() == rows.count()


def test_stages_without_documents(spark):
    rows = documents(spark, [])
    assert all(stage(spark, rows, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_only_the_result_stays(spark):
    """What the stages write on their way is gone after a run."""
    before = set(folder_names(spark, f"{shared_dir(spark)}/gapmend"))
    corpus_pipeline.run(spark, SF)
    left = set(folder_names(spark, f"{shared_dir(spark)}/gapmend")) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["packing"]
