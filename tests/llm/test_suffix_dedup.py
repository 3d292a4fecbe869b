"""Repeated byte strings against sets of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tickerloom.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows):
    """The contract, step by step."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc_id, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            window = data[k : k + 100]
            if window in seen:
                gone[k : k + 100] = True
            seen.add(window)
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


def check(spark, listed, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert listed(sd.report(df)) == brute(rows)


def prose(rng, n):
    return "".join(rng.choice("etaoinshr dlu,.\n") for _ in range(n))


def test_rows(odd, odd_rows, widen, empty, listed):
    want = brute([r[:2] for r in odd_rows])
    assert any(r[2] for r in want)
    assert listed(sd.report(odd)) == want
    assert listed(sd.report(widen(odd))) == want
    assert sd.report(empty).count() == 0


def test_passages(spark, listed):
    """Passages of many lengths at many places, in other surroundings, cut short and overlapping."""
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (98, 99, 100, 101, 131, 150, 400, 1000)]
    passages.append("éü漢字🙂 " * 12)
    rows = []
    for k in range(120):
        parts = [prose(rng, rng.randrange(0, 300))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            at = rng.randrange(0, len(p) // 3) if rng.random() < 0.5 else 0
            parts += [p[at : rng.randrange(at + len(p) // 2, len(p) + 1)], prose(rng, rng.choice([0, 1, 50]))]
        rows.append((rng.randrange(90), "".join(parts)))
    check(spark, listed, rows)


def test_text_that_repeats_itself(spark, listed):
    rows = [(1, "a" * 1000), (2, "ab" * 300), (3, "ba" * 300 + "a" * 120), (4, "abc" * 33), (5, "abc" * 34), (6, "abc" * 70)]
    rng = random.Random(2)
    period = prose(rng, 150)
    rows += [(7, period * 5), (8, period[70:] + period), (9, "x" * 99 + "y" * 99 + "x" * 100)]
    check(spark, listed, rows)


def test_a_line_in_every_document(spark, listed, monkeypatch):
    """Frequent anchors are avoided, or parted by their place in the window."""
    rng = random.Random(3)
    line = prose(rng, 60)
    banner = prose(rng, 160)
    rows = [(k, prose(rng, 80) + line + prose(rng, 90) + (banner if k % 3 else "")) for k in range(150)]
    rows += [(k + 200, line * 4 + str(k)) for k in range(40)]
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for limit in (2, 20, 1000):
        monkeypatch.setattr(sd, "HOT_SEGMENTS", limit)
        assert listed(sd.report(df)) == want


def test_one_text_in_a_third_of_all_rows(spark, listed):
    rng = random.Random(4)
    text = prose(rng, 500)
    rows = [(k if k % 2 else None, text) for k in range(100)] + [(7, text + "!")] * 30
    rows += [(k, prose(rng, 300)) for k in range(150)]
    check(spark, listed, rows)


def test_long_text(spark, listed):
    """A text of several blocks whose parts repeat across their edges."""
    rng = random.Random(6)
    part = prose(rng, 300_000)
    check(spark, listed, [(1, part[:1000] + prose(rng, 10_000)), (2, part + prose(rng, 100) + part[250_000:])], 2)


def test_kept_bytes(spark):
    text = prose(random.Random(1), 250)
    rows = [(1, text), (2, "é" + text[20:200] + "è")]
    found = {r.doc_id: bytes(r.kept) for r in sd.dedupe(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: text.encode(), 2: "éè".encode()}


def windows_of(column):
    out = set()
    for block in sd.blocks(column):
        first, sizes, anchors, _ = block.segments()
        for f, n, anchor in zip(first.tolist(), sizes.tolist(), anchors.tolist()):
            row = int(block.text[f])
            out |= {(row, f + k + int(block.offset[row]), anchor) for k in range(n)}
    return out


@pytest.mark.parametrize("block", [1, 7, 100, 1000])
def test_blocks_of_any_size(monkeypatch, block):
    rng = random.Random(block)
    texts = [prose(rng, rng.choice([0, 1, 99, 100, 101, 350])) for _ in range(12)] + [None, "", prose(rng, 200)]
    column = pa.array(["cut away", *texts, "too"], pa.string()).slice(1, len(texts))
    want = windows_of(column)
    assert {w[:2] for w in want} == {
        (row, k) for row, text in enumerate(texts) for k in range(len((text or "").encode()) - 99)
    }
    monkeypatch.setattr(sd, "BLOCK", block)
    assert windows_of(column) == want


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh"])
def test_suffix_sort(alphabet):
    rng = random.Random(alphabet)
    part = "".join(rng.choice(alphabet) for _ in range(260))
    text = (part + "".join(rng.choice(alphabet) for _ in range(500)) + part[30:] + "ab" * 150).encode()
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(len(data) - 99)
    suffixes = sd.Suffixes(data, sd.BASES[0])
    shuffled = np.random.default_rng(1).permutation(starts)
    n = len(starts)
    order = suffixes.sort(shuffled.copy(), np.zeros(n, np.int64), np.full(n, n))
    want = sorted(shuffled.tolist(), key=lambda k: text[k : k + 100])
    assert order.tolist() == want
    seen, again = set(), []
    for k in starts.tolist():
        again.append(text[k : k + 100] in seen)
        seen.add(text[k : k + 100])
    assert sd.repeated_windows(data, starts, np.zeros(n, np.int64)).tolist() == again
    # With 1 as base a hash is a sum of bytes: its collisions are found.
    weak = sd.repeated_windows(data, starts, np.zeros(n, np.int64), bases=(1, *sd.BASES))
    assert weak.tolist() == again
    if alphabet == "ab":
        with pytest.raises(RuntimeError):
            sd.repeated_windows(data, starts, np.zeros(n, np.int64), bases=(1,))


def test_groups_are_apart():
    data = np.frombuffer(b"q" * 300, np.uint8)
    starts = np.arange(0, 200, 20)
    found = sd.repeated_windows(data, starts, np.arange(10) % 2)
    assert found.tolist() == [False, False] + [True] * 8
