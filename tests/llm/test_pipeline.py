"""Each stage of the pipeline on the smallest tables against brute force over its own input."""

import pytest

import corpus_pipeline
import test_lines
import test_ngrams
import test_packing
import test_quality
import test_substrings
from conftest import words
from tabwright.llm import quality


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """(input, output) tables per stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "table")
        stage(spark, docs, sf_dir).write.parquet(path)
        out[name] = docs, spark.read.parquet(path)
        docs = out[name][1]
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_every_stage_but_the_last_keeps_the_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name
        assert after.filter("n_chars <> char_length(text)").count() == 0, name


def test_quality_rules(spark, sf_dir, stages):
    before, after = stages["quality rules"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept, given = texts(after), texts(before)
    assert all(given[i] == t for i, t in kept.items())
    counts = {i: test_quality.counts(t) for i, t in given.items()}
    passed = {i for i, c in counts.items() if c[0] >= 20 and 100 * c[4] <= 30 * c[0]}
    assert set(kept) <= passed
    good = {i for i in passed if labels.get(i) == 1}
    assert len(good - set(kept)) <= 0.02 * len(good)
    assert {r.doc_id for r in quality.quality_rules(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("kept").collect()} == set(kept)


def test_line_dedup(stages):
    before, after = stages["line dedup"]
    want = {i: "\n".join(kept) for (i, _), kept in test_lines.brute(list(texts(before).items())).items()}
    assert texts(after) == {i: t for i, t in want.items() if words(t)}


def test_ngram_jaccard_join(stages):
    before, after = stages["n-gram Jaccard join"]
    given = texts(before)
    assert texts(after) == {c: given[c] for _, c, _ in test_ngrams.brute(list(given.items()))}


def test_substring_dedup(stages):
    before, after = stages["substring dedup"]
    want = {i: kept for (i, _), (_, kept) in test_substrings.brute(list(texts(before).items())).items()}
    assert {i: words(t) for i, t in texts(after).items()} == {i: kept for i, kept in want.items() if kept}


def test_best_fit_packing(stages):
    before, after = stages["best-fit packing"]
    given = list(texts(before).values())
    number = {i: k for k, i in enumerate(texts(before))}
    rows = [r.asDict() | {"doc_id": number[r.doc_id]} for r in after.collect()]
    from pyspark.sql import Row

    n = test_packing.check([Row(**r) for r in rows], given)
    assert n <= -(-sum(r["length"] for r in rows) // 1024) * 1.05 + 1


def test_run_equals_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32")
    want = stages["best-fit packing"][1].select(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
