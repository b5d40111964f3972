"""The pipeline, stage by stage, against the operators' plain counterparts."""

import brute
import duckdb
import pytest
from compare import TABLES, connect, difference

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from daybook.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in LLM_QUERIES}
    assert {*LLM_QUERIES, "pipeline"} <= set(queries())
    assert set(LLM_ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_query_equals_sql(spark, name):
    connection = connect(SF_DIR)
    assert difference(spark, connection, LLM_QUERIES[name], LLM_ORACLES[name], SF_DIR) is None
    connection.close()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "near_duplicates",
        "repeated_passages",
        "secrets",
        "packing",
    ]
    rows = {row.doc_id: row.text for row in docs.collect()}
    kept = docs
    results = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns
        results.append({row.doc_id: row.text for row in kept.collect()})
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    good, single, cut, masked = results
    for i in good:
        n_words, _, _, _, n_repeat = brute.quality(rows[i])
        assert n_words >= 20 and 100 * n_repeat <= 30 * n_words

    ids = sorted(good)
    prints = [brute.simhash(good[i]) for i in ids]
    root = brute.components(len(ids), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    label = {i: min(k for k, other in zip(ids, root) if other == mine) for i, mine in zip(ids, root)}
    assert set(single) == {i for i in ids if label[i] == i}
    expected = brute.repeats(sorted(single.items()))
    whole = {i for i, size, gone, _, _ in expected if size == gone and size}
    assert set(single) - set(cut) <= whole | {i for i, *_ in expected if not cut.get(i)}
    for i, size, gone, _, digest in expected:
        if not gone:
            assert cut[i] == single[i]
    for i, text in cut.items():
        if not any(brute.secrets(text)[:3]):
            assert masked[i] == text or "[SECRET]" in masked[i]
        else:
            assert "[SECRET]" in masked[i]
    placed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    assert {row.doc_id for row in placed} == set(masked)


def test_run(spark):
    frame = corpus_pipeline.run(spark, SF_DIR)
    assert frame.columns == ["doc_id", "piece", "first_word", "n_words", "bin"]
    assert frame.count() > 0


def test_tables_are_there():
    assert "documents" in TABLES and duckdb.__version__
