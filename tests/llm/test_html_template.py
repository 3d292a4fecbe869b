"""What the template decides, and what it doesn't."""

import random

import pytest

from tickerloom.llm import html_text as op

PAGES = "page_id long, url string, html string"


def texts(spark, rows, **options):
    found = op.extract(spark.createDataFrame(rows, PAGES).repartition(3), whole_articles=True, **options).collect()
    return {r.page_id: r.text for r in found}


def test_names_that_only_hold_a_boilerplate_word(spark):
    text = op.main_text
    assert text("<main><section class='social-history'><p>The guilds.</p></section></main>") == "The guilds."
    assert text("<main><div class='notice-of-death'>He died.</div><div class='site-notice'>x</div></main>") == "He died."
    # Where such an element is in the host's template, it is boilerplate.
    rows = [
        (k, f"http://a.example/{k}", f"<main><p>Story {k} is long enough.</p><div class='share-zq'>tell {k}</div></main>")
        for k in range(6)
    ]
    rows[0] = (0, "http://a.example/0", "<main><p>Story 0.</p><section class='social-history'>Guilds.</section></main>")
    found = texts(spark, rows)
    assert found[0] == "Story 0.\nGuilds." and all(found[k] == f"Story {k} is long enough." for k in range(1, 6))


def test_teasers_do_not_bound_the_text():
    body = "".join(f"<p>The body has many words, this is part {k}.</p>" for k in range(20))
    found = op.main_text(f"<body><div>{body}</div><article><h2>Read on</h2></article></body>")
    assert found.count("\n") == 20 and "part 19" in found
    assert op.main_text(f"<body><div>side line</div><article>{body}</article></body>").count("\n") == 19


def plain_page(k, names, rng):
    links = "".join(f"<a href='/{rng.random()}'>link {rng.randint(0, 99)}</a> " for _ in range(5))
    menu, story, foot = names
    return (
        f"<html><body><div class='{menu}'>{links}</div><div>Welcome to our site</div>"
        f"<div class='{story}'><p>Story {k} {rng.random()}</p></div><div class='{foot}'>Call us any time</div></body></html>"
    )


@pytest.mark.parametrize("names", [("zqa", "zqb", "zqc"), ("zq1", "zq2", "zq3"), ("a7", "a8", "a9")])
@pytest.mark.parametrize("n", [3, 9, 10, 12])
def test_hosts_of_any_size_with_meaningless_names(spark, names, n):
    rng = random.Random(n)
    rows = [(k, f"http://x.example/{k}", plain_page(k, names, rng)) for k in range(n)]
    found = texts(spark, rows)
    assert all(found[k].startswith(f"Story {k} ") and "\n" not in found[k] for k in range(n))


def test_without_templates_the_text_is_another(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(k, f"http://x.example/{k}", plain_page(k, ("m", "s", "f"), rng)) for k in range(8)]
    found = texts(spark, rows)
    monkeypatch.setattr(op, "MIN_PAGES", 100)
    bare = texts(spark, rows)
    assert all("Welcome" in bare[k] and "link" in bare[k] and "Call" in bare[k] for k in range(8))
    assert all(found[k] != bare[k] and found[k] in bare[k] for k in range(8))


def test_classes_against_occurrence_vectors(spark):
    """The hashed classes are those of the vectors themselves."""
    rng = random.Random(3)
    rows = []
    for k in range(12):
        parts = "".join(
            f"<div class='{c}'>{'<p>same</p>' * rng.choice([1, 1, 2])}</div>" for c in "abcd" if rng.random() < 0.8
        )
        rows.append((k, f"http://v.example/{k}", f"<body><ul><li>one<li>two {k}</ul>{parts}</body>"))
    vectors = {}
    for k, _, html in rows:
        for token, (n, *_) in op.page_tokens(html).items():
            vectors.setdefault(token, {})[k] = n
    every = {k: 1 for k in range(12)}
    frequent = {t: v for t, v in vectors.items() if len(v) >= 6 and (t[1] == 0 or v == every)}
    found = op.equivalence_classes(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert {(r["path"], r["block"]) for r in found} == set(frequent)
    classes = {}
    for r in found:
        classes.setdefault(tuple(r["vector"]), set()).add((r["path"], r["block"]))
    want = {}
    for token, vector in frequent.items():
        want.setdefault(tuple(sorted(vector.items())), set()).add(token)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))
