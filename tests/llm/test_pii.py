import hashlib
import re

from tickerloom.llm import pii as op


def brute_base(text):
    """The base rules, by the plain patterns."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        if 14 <= len(digits) <= 19 and check % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


TEXTS = [
    "mail a.b+c@x-y.example.com, or @nobody or x@y or a@b@c.de and q@w.e.r.t.", "a@b.c@d.e f@g..h", "@@a@b.c",
    "1.2.3.4 and 256.1.1.1 1.2.3.4.5 001.02.3.255 1.2.3 9.9.9.9.9.9.9.9 99999999999999999999.1.1.1",
    "4539 1488 0343 6467 and 4539148803436467, 4539-1488-0343-6468 12 34 5", "+1 (017) 555-7713 +4 +12345 +1 2",
    "+49 170 1234567 call 555-123-4567", "phone 555-123-4567 or (555) 123 4567", "IBAN DE89 3704 0044 0532 0130 00.",
    "account GB82WEST12345698765432 and GB83WEST12345698765432", "my ssn is 123-45-6789", "order 123-45-6789",
    "🙂 é a@b.cd 漢 10.0.0.1", "7" * 500 + " " + "a" * 500, "a@b." * 200, None, "",
    "visa 4222 222 222 222", "4222222222222",
]


def test_base_spans_are_those_of_the_plain_patterns(odd_rows):
    for text in [*TEXTS, *(r[1] for r in odd_rows)]:
        found = [(k, s, e) for k, s, e, _ in op.find(text) if k in op.BASE]
        assert found == brute_base(text)


def test_the_method_adds_confirmed_spans():
    kinds = [[k for k, *_ in op.find(t)] for t in TEXTS]
    assert kinds[6] == ["phone", "local_phone"] or "phone" in kinds[6]
    assert kinds[7] == ["local_phone", "local_phone"]
    assert kinds[8] == ["iban"] and kinds[9] == ["iban"]
    assert kinds[10] == ["ssn"] and kinds[11] == []
    assert kinds[-2] == ["short_card"] and kinds[-1] == []


def test_report(spark, listed, widen):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = []
    for doc_id, text in rows:
        base = brute_base(text)
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        counts = [sum(k == kind for k, _, _ in base) for kind in op.BASE]
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in op.find(text))
        expected.append((doc_id, *counts, hashlib.sha256(written.encode()).hexdigest(), spans))
    expected.sort(key=lambda r: [(x is None, x) for x in r])
    assert listed(op.report(df)) == expected
    assert listed(op.report(widen(df))) == expected


def test_redact(spark, odd, empty, listed):
    rows = [(1, "a a@b.cd, 1.2.3.4!", "en", "s", 18), (2, None, None, None, None), (3, "clean", "en", "s", 99)]
    df = spark.createDataFrame(rows, odd.schema)
    assert listed(op.redact(df)) == [(1, "a <EMAIL>, <IP>!", "en", "s", 16), rows[2 - 1], rows[2]]
    assert op.redact(empty).count() == 0
    assert listed(op.redact(df.select("doc_id", "text")))[0] == (1, "a <EMAIL>, <IP>!")
    assert op.masked("ab", [("card", 0, 2, 1.0), ("phone", 1, 2, 1.0)]) == "<CARD>"


def test_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.2." * 50_000, "+1 " * 50_000, "1-" * 100_000):
        op.find(text)
