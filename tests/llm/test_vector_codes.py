"""Vector codes against plain loops over all entries in Python's integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tickerloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def whole(x):
    return math.floor(Fraction(x) * 1024)


def brute(rows, entries=256, rounds=4):
    """The contract, step by step."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    longest = max((len(r[1]) for r in rows), default=0)
    length = -(-longest // 4)
    parts = []
    for _, vector, _ in rows:
        numbers = [whole(x) for x in vector] + [0] * (4 * length - len(vector))
        parts.append([numbers[p * length : (p + 1) * length] for p in range(4)])
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    books = [[list(parts[k][p]) for k in order[:entries]] for p in range(4)]

    def assign():
        out = []
        for row in parts:
            out.append([
                min((sum((a - b) ** 2 for a, b in zip(row[p], c)), e) for e, c in enumerate(books[p]))
                for p in range(4)
            ])
        return out

    for _ in range(rounds):
        near = assign()
        for p in range(4):
            for e in range(len(books[p])):
                mine = [row[p] for row, n in zip(parts, near) if n[p][1] == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine)]
    near = assign()
    errors = [sum(d for d, _ in n) for n in near]
    by_label = {}
    for (_, _, label), error in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [
        (i, "".join(f"{e:02x}" for _, e in n), error, by_label[label], digest)
        for (i, _, label), n, error in zip(rows, near, errors)
    ]


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(12)]
    out = []
    for k in range(700):
        centre = rng.choice(centres)
        out.append((k * 3 % 701, [x + rng.gauss(0, 0.1) for x in centre], None if k % 9 == 0 else k % 4))
    out += [out[5], out[5], (7, out[9][1], 1), (None, out[3][1], None), (1, None, 1), (2, [None] * 20, 2)]
    out += [(3, [0.5] * 19 + [x], 3) for x in (float("nan"), float("inf"), -float("inf"))]
    out += [(4, [0.0] * 20, 3), (5, [-0.0005] * 20, None), (900, [1.0, 2.0], 0), (901, [], 0)]
    return out


def test_rows(spark, rows, widen, listed):
    want = ordered(brute(rows))
    assert listed(vc.report(table(spark, rows))) == want
    assert listed(vc.report(widen(table(spark, rows)))) == want


@pytest.mark.parametrize("n", [1, 5, 300])
def test_repeated_vectors_and_short_codebooks(spark, n, listed):
    rows = [(k // 2, [float(k % 3), 0.0, 1.0, -1.5, 2.0], k % 2) for k in range(n)]
    assert listed(vc.report(table(spark, rows))) == ordered(brute(rows))


def test_empty(spark):
    assert vc.report(table(spark, [(1, None, 2)])).count() == 0
    assert vc.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.code for r in vc.report(table(spark, [(1, [], 2), (2, [], 2)])).collect()] == ["00000000"] * 2


def test_large_components(spark, listed):
    rng = random.Random(8)
    rows = [(k, [rng.choice([1e5, 1e9, -1e17, 3.0]) * rng.random() for _ in range(8)], k % 2) for k in range(60)]
    rows += [(100, [1e300, 1.0, 0.0, 2.0, 5.0, 6.0, 7.0, -1e308], 5), (101, [1.7e308] * 8, 5)]
    want = [
        (*r[:2], r[2] if r[2] < 1 << 63 else None, r[3] if r[3] < 1 << 63 else None, r[4]) for r in brute(rows, rounds=4)
    ]
    errors = {i: r[2] for i, r in zip((x[0] for x in rows), want)}
    found = listed(vc.report(table(spark, rows)))
    for (i, code, error, label_error, digest), other in zip(found, ordered(want)):
        assert (i, code, error, digest) == (other[0], other[1], errors[i], other[4])


def test_transform_is_in_sequency_order_and_keeps_distances():
    for size in (1, 2, 4, 8, 16, 32):
        matrix = vc.transformed(np.eye(size, dtype=np.int64)).T
        assert [(np.diff(row) != 0).sum() for row in matrix] == list(range(size))
    rng = np.random.default_rng(1)
    for length in (1, 3, 5, 16, 17):
        a, b = rng.integers(-2000, 2000, (2, 50, length))
        size = vc.transformed(a).shape[1]
        assert (((vc.transformed(a) - vc.transformed(b)) ** 2).sum(1) == size * ((a - b) ** 2).sum(1)).all()


@pytest.mark.parametrize("span", [2, 1000, 1 << 40])
def test_nearest(span):
    rng = np.random.default_rng(span)
    for length in (1, 2, 7, 16):
        rows, entries = rng.integers(-span, span, (300, length)), rng.integers(-span, span, (40, length))
        index, distance = vc.nearest(rows, entries)
        for row, i, d in zip(rows.tolist(), index.tolist(), distance.tolist()):
            best = min((sum((a - b) ** 2 for a, b in zip(row, e)), k) for k, e in enumerate(entries.tolist()))
            assert best == (d, i)


def test_limbs():
    for number in (0, 1, -1, 1 << 40, -(1 << 40), (1 << 200) + 12345, -(1 << 123) - 7):
        assert sum(x << (vc.LIMB_BITS * k) for k, x in enumerate(vc._limbs(number))) == number


def test_labels_that_are_dealt_out(spark, monkeypatch, rows, listed):
    monkeypatch.setattr(vc, "HOT_SHARE", 0.22)
    assert listed(vc.report(table(spark, rows))) == ordered(brute(rows))


def test_decode(spark, rows):
    kept = vc.kept(table(spark, rows))
    books = vc.fit(kept)
    for r in vc.decode(vc.encode(kept, books), books).collect():
        codes = [int(r.code[k : k + 2], 16) for k in range(0, 8, 2)]
        assert r.decoded == [x / 1024 for book, c in zip(books.books, codes) for x in book[c].tolist()]
