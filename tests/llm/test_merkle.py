import hashlib
import random

from tickerloom.llm import merkle as op

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    texts = [t or "" for _, t in order]
    out = []
    for k, (doc_id, _) in enumerate(order):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, edited = (op.fingerprint(t) for t in (text, following, changed))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), digest, own, edited, op.likeness(own, edited), op.likeness(own, other)))
    return sorted(out, key=lambda r: [(x is None, x) for x in r])


def test_brute_force(odd, odd_rows, listed, widen):
    expected = brute([r[:2] for r in odd_rows])
    for df in (odd, widen(odd)):
        assert listed(op.report(df), *COLUMNS) == expected
    assert listed(op.compare_with_next(odd, ranges=1), *COLUMNS) == expected


def test_one_row_and_none(spark, odd, empty, listed):
    row = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    (found,) = listed(op.report(row), "edited_sha256", "near_next")
    assert found == (hashlib.sha256(b"abcabc").hexdigest(), 1.0)
    assert op.report(empty).count() == 0
    nameless = odd.where("doc_id is null")
    assert op.report(nameless).count() == nameless.count()


def test_real_rows(spark, listed):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = listed(op.report(df), *COLUMNS)
    assert found == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    near = [r[5] for r in found if r[1] > 200]
    assert 0.35 < sum(near) / len(near) < 0.75


def test_roots_test_equality_and_branches_locate_edits():
    rng = random.Random(1)
    lines = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(12)) + "." for _ in range(60)]
    text = "\n".join(lines)
    changed = "\n".join([*lines[:30], "another line.", *lines[31:]])
    first, second = op.fingerprint(text), op.fingerprint(changed)
    assert op.fingerprint(text) == first and op.parsed(first)[0] != op.parsed(second)[0]
    left, right = op.differing(first, second)
    assert len(left) == len(right) == 1
    section, paragraph = left[0]
    before = sum(len(s) for _, s in op.parsed(first)[1][:section])
    assert before + paragraph == 30
    assert op.differing(first, first) == ([], [])
    assert 0.9 < op.likeness(first, second) < 1


def test_likeness_bounds():
    texts = ["", "a", "a b c", "a b c.", "x" * 1000, "x" * 500 + "y" * 500, "\n\n\n", "p.\n\np.\n\nq."]
    prints = [op.fingerprint(t) for t in texts]
    for i, a in enumerate(prints):
        for j, b in enumerate(prints):
            value = op.likeness(a, b)
            assert 0 <= value <= 1 and value == op.likeness(b, a)
            assert (value == 1 and a == b) == (i == j)
    assert op.likeness(prints[4], prints[5]) > 0.3
