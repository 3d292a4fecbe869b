import hashlib
import random

import numpy as np
import pytest

from tickerloom.llm import substring_dedup as op


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc_id, text in order:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone |= set(range(i, i + 20))
            seen.add(window)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: [(x is None, x) for x in r])


def test_brute_force(odd, odd_rows, listed, widen):
    expected = brute([r[:2] for r in odd_rows])
    assert listed(op.report(odd)) == expected
    assert listed(op.report(widen(odd))) == expected


def test_empty(empty):
    assert op.report(empty).count() == 0
    assert op.dedupe(empty).columns == ["doc_id", "n_words", "n_removed", "kept"]


@pytest.fixture(scope="module")
def woven():
    """Passages that recur whole, cut, across and inside documents; periodic texts; one common line."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.randint(15, 70))] for _ in range(12)]
    common = [rng.choice(words) for _ in range(14)]
    rows = []
    for k in range(160):
        text = []
        for _ in range(rng.randint(0, 6)):
            text += [rng.choice(words) for _ in range(rng.randint(0, 40))]
            p = rng.choice(passages)
            text += p[rng.randint(0, 5) : rng.randint(10, 70)]
            text += common if rng.random() < 0.5 else []
        rows.append((k, " ".join(text)))
    rows += [(200, "a " * 500), (201, "a b c " * 200), (202, "b c a " * 90), (203, rows[3][1]), (204, rows[3][1])]
    return rows


@pytest.mark.parametrize("shard, hot", [(op.SHARD_WORDS, op.HOT_SEGMENTS), (300, 30), (300, 2)])
def test_shards_and_frequent_anchors(spark, woven, listed, monkeypatch, shard, hot):
    monkeypatch.setattr(op, "SHARD_WORDS", shard)
    monkeypatch.setattr(op, "HOT_SEGMENTS", hot)
    df = spark.createDataFrame(woven, "doc_id long, text string").repartition(5)
    assert listed(op.report(df)) == brute(woven)


def test_kept_words(spark):
    line = " ".join(f"x{k}" for k in range(25))
    df = spark.createDataFrame([(1, f"a {line} b"), (2, f"c {line}\n d")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in op.dedupe(df).collect()} == {1: f"a {line} b", 2: "c d"}


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(3)
    for n in (0, 19, 20, 21, 200, 1000):
        h = rng.integers(0, 5 if n > 500 else 1 << 62, n).astype(np.uint64)
        starts, counts, anchors, grams = op.segments(h)
        assert counts.sum() == max(0, n - 19) and (counts <= op.LONGEST).all()
        for s, c, a in zip(starts, counts, anchors):
            for w in range(s, s + c):
                assert grams[w : w + op.GRAMS].min() == a


def test_backward_search_counts_patterns():
    rng = np.random.default_rng(9)
    symbols = np.concatenate([rng.integers(1, 4, 400), [0], rng.integers(1, 4, 300), [0]])
    index = op.FMIndex(symbols, 4)
    for _ in range(60):
        pattern = rng.integers(1, 4, rng.integers(1, 9))
        start, end = np.array([0]), np.array([len(symbols)])
        for s in pattern[::-1]:
            start, end = index.extend(np.array([s]), start, end)
        cyclic = np.concatenate([symbols, symbols[:10]])
        expected = sum((cyclic[i : i + len(pattern)] == pattern).all() for i in range(len(symbols)))
        assert end[0] - start[0] == expected


def test_ranks():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 37, 1000)
    matrix = op.WaveletMatrix(values, 37)
    asked, ends = rng.integers(0, 37, 200), rng.integers(0, 1001, 200)
    _, found = matrix.ranks(asked, np.zeros(200, np.int64), ends)
    assert found.tolist() == [int((values[:e] == s).sum()) for s, e in zip(asked, ends)]


def test_rows_of_one_id_are_documents_of_their_own(spark, woven, listed):
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t) for k, (_, t) in enumerate(woven)]
    rows += [(None, woven[3][1])] * 20 + [(7, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert listed(op.report(df)) == brute(rows)
    numbered = [tuple(r) for r in op._numbered(df, 4).collect()]
    assert len({r[:2] for r in numbered}) == len(numbered) == len(rows)
    for some in (df, df.where("doc_id > 7")):
        assert [f.nullable for f in op._numbered(some, 4).schema][:2] == [False, False]
    for key in (op.NO_ID, 7):
        texts = [t or "" for k, _, t in sorted(numbered, key=lambda r: r[:2]) if k == key]
        assert texts == sorted(texts) and len(texts) > 50


def test_numbers_of_copies_have_no_bound():
    import pyarrow as pa

    text = " ".join(f"y{k}" for k in range(30))
    columns = [pa.array([1, 1]), pa.array([1 << 24, 1 << 60]), pa.array([text, text])]
    (out,) = op._list_segments([pa.RecordBatch.from_arrays(columns, names=["key", "copy", "text"])])
    assert set(out.column("copy").to_pylist()) == {1 << 24, 1 << 60}
    assert all(0 < p < 30 * op.START for p in out.column("place").to_pylist())
