"""The pipeline against a version without Spark."""

import pytest
from test_decontamination import brute as contaminated
from test_simhash import brute as simhashes
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tickerloom.llm import language_id, pii
from tickerloom.llm.queries import tokenizer_file
from tickerloom.sources.stages import staged

SMALL = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "simhash", "decontamination", "pii", "packing"]


@pytest.fixture(scope="module")
def expected(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r["doc_id"] for r in language_id.report(docs).where("accepted").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect() if r["doc_id"] in good]
    groups = {doc_id: component for doc_id, _, component in simhashes(rows)}
    rows = [r for r in rows if groups[r[0]] == r[0]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    dirty = {r[0] for r in contaminated(rows, items) if r[-1]}
    rows = [(d, pii.masked(t, pii.find(t))) for d, t in rows if d not in dirty]
    encode = Tokenizer.from_file(tokenizer_file()).encode
    return {d: len(encode(t, add_special_tokens=False).ids) + 1 for d, t in rows}


def test_run(spark, expected):
    found = pipeline.run(spark, SMALL).collect()
    lengths, sequences = {}, {}
    for r in found:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert lengths == expected
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_odd_rows_pass_through(spark, odd, widen, empty):
    for df in (odd, widen(odd), empty):
        docs = staged(df, "odd")
        for name, stage in pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = staged(stage(spark, docs, SMALL), name)
            assert docs.columns == columns
        last = pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert {"doc_id", "sequence_id", "offset", "length"} <= set(last.columns)
        last.count()
