import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tickerloom.llm import decontamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        w, hit, names = WORD.findall(lower(text)), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                found = windows.get(tuple(w[i : i + k]))
                if found:
                    hit |= set(range(i, i + k))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=lambda r: [(x is None, x) for x in r])


@pytest.fixture(scope="module")
def items(odd_rows):
    words = WORD.findall(lower(odd_rows[6][1]))
    return [
        (1, " ".join(words[5:30])), (12, "Seven QUIET birds"), (3, None), (4, ""), (5, "straße"),
        (3, " ".join(words[40:50])), (None, " ".join(words[100:111])), (1, " ".join(words[5:30])),
        (7, "never seen words " * 9), (8, "a a"),
    ]


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_brute_force(odd, odd_rows, benchmark, items, listed, widen):
    expected = brute([r[:2] for r in odd_rows], items)
    assert listed(op.report(odd, benchmark)) == expected
    assert listed(op.report(widen(odd), widen(benchmark))) == expected


def test_many_passes(odd, benchmark, listed, monkeypatch):
    whole = listed(op.report(odd, benchmark))
    clean = listed(op.clean_documents(odd, benchmark))
    monkeypatch.setattr(op, "WORDS_PER_PASS", 12)
    assert listed(op.report(odd, benchmark)) == whole
    assert listed(op.clean_documents(odd, benchmark)) == clean


def test_clean_documents_keep_rows_and_columns(odd, odd_rows, benchmark, items, listed):
    flags = {r[:2]: brute([r[:2]], items)[0][-1] for r in odd_rows}
    kept = sorted([r for r in odd_rows if not flags[r[:2]]], key=lambda r: [(x is None, x) for x in r])
    assert listed(op.clean_documents(odd, benchmark)) == kept


def test_empty_tables(odd, empty, benchmark):
    nothing = benchmark.limit(0)
    assert op.report(empty, benchmark).count() == 0
    assert op.report(odd, nothing).where("contaminated").count() == 0
    assert op.clean_documents(odd, nothing).count() == odd.count()


def test_shift_tables_find_what_a_scan_finds():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice(b"abc") for _ in range(80)]
        length = rng.randint(1, 5)
        patterns = {tuple(rng.choice(b"abc") for _ in range(length)) for _ in range(6)}
        expected = [
            (i, tuple(words[i : i + length]))
            for i in range(81 - length)
            if tuple(words[i : i + length]) in patterns
        ]
        assert list(op.WuManber(patterns, length).search(words)) == expected


def test_shift_skips():
    table = op.WuManber([tuple(range(10))], 10)
    assert table.shift.get((98, 99), table.farthest) == 9


def test_spans(spark, benchmark):
    doc = spark.createDataFrame([(1, "x seven quiet birds, y")], "doc_id long, text string")
    row = op.search(doc, benchmark).first()
    assert row["covered"] == [[1, 4]] and row["items"] == ["12"]
    assert op.search(doc.withColumn("doc_id", F.lit("a")), benchmark).first()["doc_id"] == "a"


def test_copies_of_an_item_and_a_long_one_are_parted(spark, monkeypatch, listed):
    rng = random.Random(21)
    words = [f"w{k}" for k in range(60)]
    long_item = " ".join(rng.choice(words) for _ in range(3000))
    benchmark = [(k % 3, "one short question about stone and water near the old bridge") for k in range(5000)]
    benchmark += [(10, long_item), (None, long_item[:200])]
    docs = [(k, " ".join(rng.choice(words) for _ in range(40)) + " " + long_item[k * 50 : k * 50 + 200]) for k in range(40)]
    docs.append((99, "and ONE short question, about stone and water near the old bridge"))
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    want = listed(op.report(documents, items))
    monkeypatch.setattr(op, "WORDS_PER_PASS", 400)
    sizes = []
    monkeypatch.setattr(op, "_Pass", type("_Pass", (op._Pass,), {"__init__": lambda self, s, rows: (sizes.append(len(rows)), op_init(self, s, rows))[1]}))
    assert listed(op.report(documents, items)) == want
    assert len(sizes) > 5 and max(sizes) < 700
    found = {r.doc_id: r for r in op.search(documents, items).collect()}
    assert found[99]["items"] == ["0", "1", "2"]
    assert sum(bool(r["items"]) for r in found.values()) > 20


op_init = op._Pass.__init__


def test_text_of_many_megabytes(spark):
    text = "stone river " * 500_000 + "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "One, two three four five six seven eight nine ten")], "item_id long, text string")
    row = op.report(docs, items).first()
    assert (row.n_words, row.n_hit, row.n_items) == (1_000_010, 10, 1)
