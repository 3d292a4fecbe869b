"""Encoder, packing and token store against the tokenizers library and brute force."""

import glob
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickerloom.llm import packing, token_store
from tickerloom.llm.queries import tokenizer_file
from tickerloom.llm.tokens import Encoder

PATH = tokenizer_file()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


STRANGE = [
    "it's we've I'LL 'd ''s don't", "<|endoftext|> a<|startoftext|>b <|END", "ÀÉÎ Ø÷× ß ẞ Σ ς İ ı ﬁ", "é ́x a b c",
    "THE!! a.b,c;d 12ab34 x_y ©®™ ½²Ⅷ", "漢字かな 🙂👍🏽 ‍ ﻿", "a\x1cb\x1dc\x85d \x00 \x7f", "  \n\t ", "'", "<", "a<b", "###%%%$$$&&&***|",
    "\u0000\u0001 ퟿ ªº µ",
]


def test_ids_are_those_of_the_library(library, odd_rows, spark):
    coder = Encoder(PATH)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*STRANGE, *texts, *(r[1] for r in odd_rows)] * 2:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library(text)


def test_small_cache(library, monkeypatch):
    monkeypatch.setattr("tickerloom.llm.tokens.CACHED_CHUNKS", 3)
    coder = Encoder(PATH)
    text = "one two three four five one, two. THREE four! five " * 3
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == library(text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def packed_fairly(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity."""
    by_sequence = {}
    for length, sequence, offset in rows:
        by_sequence.setdefault(sequence, []).append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pack(odd, odd_rows, library, widen, listed):
    expected = []
    for doc_id, text, *_ in odd_rows:
        ids = library(text) + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            expected.append((doc_id, k, at, len(ids[at : at + 4096]), crc(ids[at : at + 4096])))
    expected.sort(key=lambda r: [(x is None, x) for x in r])
    for df in (odd, widen(odd)):
        found = packing.pack(df, PATH)
        assert listed(found, "doc_id", "piece", "start", "length", "ids_crc32") == expected
        used = packed_fairly(listed(found, "length", "sequence_id", "offset"), 4096)
        total = sum(r[3] for r in expected)
        assert -(-total // 4096) <= used <= -(-total // 4096) + 1


def test_cut_documents(spark, library, listed):
    df = spark.createDataFrame([(1, "stone " * 9000), (2, "x")], "doc_id long, text string")
    assert [r[2:4] for r in listed(packing.pack(df, PATH), "doc_id", "piece", "start", "length")] == [
        (0, 4096), (4096, 4096), (8192, 809), (0, 2),
    ]


def test_empty(empty):
    assert packing.pack(empty, PATH).count() == 0
    assert token_store.report(empty, PATH).count() == 0


def seated(counts, capacity):
    rows = []
    for length, (ranks, firsts, each, offsets) in packing.plan(counts, capacity).items():
        ends = [*ranks[1:], counts[length]]
        assert ranks[0] == 0
        for rank, end, first, per, offset in zip(ranks, ends, firsts, each, offsets):
            rows += [(length, first + k // per, offset + k % per * length) for k in range(end - rank)]
    return rows


def matched_one_by_one(lengths, capacity):
    """Sequences of the method, piece by piece."""
    left = sorted(lengths, reverse=True)
    large = [x for x in left if 3 * x > capacity]
    gaps = []
    while large:
        first = large.pop(0)
        mate = next((k for k, x in enumerate(large) if first + x <= capacity), None)
        gaps.append(capacity - first - (large.pop(mate) if mate is not None else 0))
    for x in (x for x in left if 3 * x <= capacity):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - x)
        else:
            gaps.append(capacity - x)
    return len(gaps)


def test_plan_uses_as_many_sequences_as_the_method_step_by_step():
    rng = random.Random(4)
    for _ in range(300):
        capacity = rng.choice([10, 37, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 20))}
        lengths = [x for x, n in counts.items() for _ in range(n)]
        rows = seated(counts, capacity)
        assert sorted(r[0] for r in rows) == sorted(lengths)
        assert packed_fairly(rows, capacity) == matched_one_by_one(lengths, capacity)


def test_store_round_trip(odd, odd_rows, library, widen, listed):
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for doc_id, text, *_ in order:
        ids = library(text) + [1]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    expected.sort(key=lambda r: [(x is None, x) for x in r])
    assert listed(token_store.report(odd, PATH)) == expected
    assert listed(token_store.report(widen(odd), PATH)) == expected


def test_keyed_access(odd, odd_rows, library):
    shards = [token_store.ShardReader(r["path"]) for r in token_store.write(odd, PATH, shards=3).collect()]
    for key in {r[0] for r in odd_rows if r[0] is not None}:
        found = [ids.tolist() for s in shards for ids in s.get(key)]
        expected = [library(r[1]) + [1] for r in odd_rows if r[0] == key]
        assert sorted(found) == sorted(expected)
    for key in (-1, 10**6, 10**15):
        assert not [ids for s in shards for ids in s.get(key)]


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        index = token_store.PerfectHash.build(keys)
        assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
        assert sum(len(words) * 64 for words in index.levels) <= 64 * 40 + 8 * len(keys)


def test_a_retried_task_leaves_only_files_that_nothing_names(odd, spark):
    manifest = token_store.write(odd, PATH, shards=2).collect()
    folder = manifest[0]["path"].rpartition("/")[0]
    open(f"{folder}/shard-000000-lost.tok", "wb").write(b"half a shard")
    assert len(glob.glob(f"{folder}/*.tok")) == len(manifest) + 1
    assert token_store.read(spark.createDataFrame(manifest)).count() == odd.count()


def test_frequent_ids_span_shards(spark, library, listed):
    """A third of the rows without an id and a third with the same one: no shard is above twice the mean."""
    rng = random.Random(9)
    words = "stone river light bridge seven quiet".split()
    rows = [
        (None if k % 3 == 0 else 7 if k % 3 == 1 else 1000 + k, " ".join(rng.choice(words) for _ in range(12)))
        for k in range(3000)
    ]
    rows += [(7, "the same text every time")] * 600
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    manifest = token_store.write(df, PATH, 8)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * len(rows) / len(sizes)
    found = token_store.read(manifest).orderBy("start").collect()
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    starts = np.cumsum([0, *(r.n_tokens for r in found)])
    assert [r.start for r in found] == starts[:-1].tolist()
    want = sorted((k is not None, k or 0, len(library(t)) + 1, crc(library(t) + [1])) for k, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == want


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr("tickerloom.llm.tokens.PART_CHARS", 40)
    coder = Encoder(PATH)
    texts = [" ".join(STRANGE[:9] * 3), "a" * 200 + " b", "word " * 100, "", None, " 　x" * 50, "İstanbul's " * 20]
    for text, ids in zip(texts, coder.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library(text)


def test_merges_of_random_words(library):
    rng = random.Random(12)
    coder = Encoder(PATH)
    words = ["".join(rng.choice("etaoinshrdluéà#&*") for _ in range(rng.randrange(1, 45))) for _ in range(4000)]
    for word, ids in zip(words, coder.encode_all(words)):
        assert np.frombuffer(ids, "<u4").tolist() == library(word)


def test_few_texts_are_cut_into_pieces_at_a_time(monkeypatch):
    """The pieces of a part are Python strings, many times as large as the text."""
    import public_tokenizers

    from tickerloom.llm import tokens

    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    joined, most = encoder._joined, []

    def watch(waiting):
        most.append(sum(len(piece) for pieces in waiting for piece in pieces))
        return joined(waiting)

    monkeypatch.setattr(encoder, "_joined", watch)
    texts = [f"word{k} " * 2_000 for k in range(150)]
    assert len(list(encoder.encode_all(texts))) == 150
    assert sum(most) > 1_500_000 and max(most) < 1_200_000
