"""Fill-in-the-middle against plain regular expressions, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest

from tickerloom.llm import fill_middle as fim

TOKENS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def offsets(text):
    return [0, *(m.end() for m in TOKENS.finditer(text))]


def expected(doc_id, text):
    """The contract, step by step."""
    text = text or ""
    tokens = TOKENS.findall(text)
    n = len(tokens)
    name = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[k : k + 8], 16) for k in (0, 8, 16, 24)]
    digest = hashlib.sha256(text.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, digest, digest
    a, b = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), hashlib.sha256(output.encode()).hexdigest(), digest


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


def test_rows(odd, odd_rows, widen, empty, listed):
    want = ordered([expected(r[0], r[1]) for r in odd_rows])
    assert listed(fim.report(odd)) == want
    assert listed(fim.report(widen(odd))) == want
    assert fim.report(empty).count() == 0


def test_marked_texts_stay_plain(spark, listed):
    texts = ["a <P> b", "<S>", "x<M", "<<P", "<P", "a<", "<M><M>", "P>S>M>", "<p>"]
    rows = [(k, texts[k % len(texts)]) for k in range(300)]
    found = listed(fim.report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == ordered([expected(*r) for r in rows])
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_outputs_are_rebuilt(odd):
    for r in fim.transform(odd, rate=100, spm_rate=50).collect():
        assert fim.restored(r.output, r.form) is not None
    for form in ("psm", "spm"):
        for text in ("<", "<<", "a<S", "<M", "S>", "a<b<c>"):
            for first in range(len(text) + 1):
                for second in range(first, len(text) + 1):
                    assert fim.restored(fim.arranged(text, form, first, second), form) == text


def test_rates_and_seed(odd):
    forms = {r.form for r in fim.transform(odd.where("length(text) > 0"), rate=100, spm_rate=100).collect()}
    assert forms == {"spm"}
    assert {r.form for r in fim.transform(odd, rate=0).collect()} == {"plain"}


@pytest.mark.parametrize("kind", ["prose", "letters", "marks", "mixed", "sparse"])
def test_long_texts(kind):
    """Every kind of container, also where a token spans the edge between two."""
    rng = random.Random(kind)
    n = 200_000 if kind == "sparse" else 140_001
    text = {
        "prose": lambda: "".join(rng.choice(["stone ", "a, ", "é", "🙂x "]) for _ in range(n // 4)),
        "letters": lambda: "a" * n,
        "marks": lambda: "." * n,
        "mixed": lambda: "".join(rng.choice("a.") for _ in range(n)),
        "sparse": lambda: "".join("." * (rng.random() < 0.001) + "xy" for _ in range(n // 2)),
    }[kind]()
    found, want = fim.Boundaries(text), offsets(text)
    assert len(found) == len(want)
    places = {0, len(want) - 1, *(rng.randrange(len(want)) for _ in range(500))}
    assert all(found.select(k) == want[k] for k in places)
    kinds = {type(c) for c in found.containers}
    if kind == "mixed":
        assert fim.BitmapContainer in kinds
    if kind == "marks":
        assert kinds <= {fim.RunContainer, fim.ArrayContainer}


@pytest.mark.parametrize("n", [0, 1, 65_534, 65_535, 65_536, 65_537, 131_072])
def test_ends_at_the_edge_of_a_container(n):
    for text in ("a" * n, ("ab " * n)[:n]):
        found, want = fim.Boundaries(text), offsets(text)
        assert len(found) == len(want)
        assert [found.select(k) for k in range(0, len(want), max(1, len(want) // 50))] == want[:: max(1, len(want) // 50)]
        assert found.select(len(want) - 1) == want[-1]


def test_containers_agree():
    rng = np.random.default_rng(3)
    for share in (0.01, 0.3, 0.97):
        members = np.flatnonzero(rng.random(fim.CHUNK) < share)
        for kind in (fim.ArrayContainer, fim.BitmapContainer, fim.RunContainer):
            made = kind(members)
            assert made.size == len(members)
            assert all(made.select(k) == members[k] for k in range(0, len(members), 97))
        assert fim.container(members).nbytes == min(
            k(members).nbytes for k in (fim.ArrayContainer, fim.BitmapContainer, fim.RunContainer)
        )


def test_text_of_many_megabytes(spark, listed):
    text = "stone river, " * 400_000
    df = spark.createDataFrame([(3, text)], "doc_id long, text string")
    assert listed(fim.report(df)) == [expected(3, text)]
