import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import language_id as op

SYLLABLES = {
    "en": "the and with of ing tion".split(),
    "fr": "eau que ment ère le ou".split(),
    "de": "sch ung der keit ich ß".split(),
}


def text_in(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    rows = []
    for k in range(400):
        lang = rng.choice(list(SYLLABLES))
        rows.append((k, text_in(rng, lang, rng.randint(3, 80)), lang, f"{lang}.host{k % 5}.example.com"))
    rows += [
        (900, "漢字仮名交じり文" * 20, None, "x.example.com"), (901, "", "en", None), (902, None, None, None),
        (903, "12 34 ### 56", "fr", "x"), (904, text_in(rng, "de", 40), None, None), (None, text_in(rng, "fr", 40), "fr", "a.b"),
        (905, text_in(rng, "en", 40), "xx", "y.de"),
    ]
    rows += [rows[0], rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), rows


def test_languages(corpus):
    df, rows = corpus
    found = {r["doc_id"]: r for r in op.report(df).collect()}
    assert op.report(df).count() == len(rows)
    for doc_id, _, lang, _ in rows[:400]:
        assert found[doc_id]["language"] == lang and found[doc_id]["accepted"]
    for doc_id in (900, 901, 902, 903):
        assert found[doc_id]["language"] == "und" and not found[doc_id]["accepted"]
    assert found[901]["posterior"] == 0
    assert (found[904]["language"], found[None]["language"], found[905]["language"]) == ("de", "fr", "en")


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op.fit(df.where("doc_id % 2 = 0"))
    held = df.where("doc_id % 2 = 1")
    found = op.identify(held.withColumn("lang", F.lit(None).cast("string")), model=model)
    found = found.join(held.select("doc_id", "lang"), "doc_id")
    right = found.where("language = lang").count()
    assert right >= 0.98 * found.count()
    assert found.where("accepted").count() >= 0.99 * found.count()


def test_rows_and_columns_stay(corpus, widen, listed):
    df, rows = corpus
    kept = op.accepted(df, host=F.col("source"))
    assert kept.columns == df.columns
    expected = [r for r in rows if r[0] not in (900, 901, 902, 903)]
    assert listed(kept) == sorted(expected, key=lambda r: [(x is None, x) for x in r])
    wide = widen(df)
    assert op.accepted(wide, host=F.col("source")).columns == wide.columns
    assert op.accepted(wide, host=F.col("source")).count() == len(expected)


def test_empty(empty):
    assert op.report(empty).count() == 0
    assert op.accepted(empty).count() == 0


def test_each_kind_of_evidence_can_decide():
    counts = np.ones((2, op.BUCKETS))
    model = op.Model(["de", "en"], counts)
    scores, sizes = np.zeros((1, 3)), np.array([9])
    even = np.array([[0.495, 0.495, 0.01]])

    def best(declared=None, suffix=None, priors=even):
        return op.fuse(model, scores, sizes, [declared], [suffix], priors)[0][0]

    assert best(declared="en") == "en" and best(declared="de") == "de"
    assert best(suffix="de") == "de" and best(suffix="uk") == "en"
    assert best(priors=np.array([[0.1, 0.89, 0.01]])) == "en"
    assert best(declared="en", suffix="de") == "en"


def test_host_priors_are_smoothed_by_the_levels_above(corpus):
    df, rows = corpus
    model = op.fit(df)
    shared = df.sparkSession.sparkContext.broadcast(model)
    priors = {r["host"]: r["prior"] for r in op.host_priors(df, shared, F.col("source")).collect()}
    assert all(abs(sum(p) - 1) < 1e-9 for p in priors.values())
    at = model.languages.index("fr")
    assert priors["fr.host0.example.com"][at] > 0.5 > priors["de.host0.example.com"][at]
    labels = [r[2] for r in rows[:400]] + ["en", "en"] * 0
    assert 0.1 < priors["x.example.com"][at] < 0.6 and len(labels) == 400


def test_pages_keep_null_and_repeated_ids(spark, tmp_path):
    from tickerloom.llm import queries

    rng = random.Random(3)
    rows = [
        (k, f"http://h{k % 3}.example.{lang}/{k}", f"<html lang={lang}><p>{text_in(rng, lang, 40)}</p></html>")
        for k, lang in enumerate(["en", "fr", "de"] * 10)
    ]
    rows += [(None, *r[1:]) for r in rows[:7]] + [(3, *r[1:]) for r in rows[:7]] + [(99, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.language_id_pages(spark, str(tmp_path)).collect()
    expected = [(r[0], "und" if r[2] is None else r[2][11:13]) for r in rows]
    key = lambda r: [(x is None, x) for x in r]
    assert sorted(((r["page_id"], r["language"]) for r in found), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_languages_of_few_rows(spark, n):
    rng = random.Random(n)
    few = [(k, text_in(rng, lang, 40), lang, f"s.{k}") for k, lang in enumerate(["fr", "de"] * n)]
    many = [(100 + k, text_in(rng, "en", 40), "en", "s") for k in range(50)]
    silent = [(300, "12 34", "zz", "s")]
    for rows in (few, few + many + silent):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        found = {r["doc_id"]: (r["language"], r["accepted"]) for r in op.report(df).collect()}
        assert all(found[r[0]] == (r[2], True) for r in rows if r[2] != "zz")
        assert "zz" not in op.fit(df).languages
        assert op.accepted(df, host=F.col("source")).count() == len(rows) - (rows != few)


def test_copies_of_a_text_are_drawn_once(spark):
    rng = random.Random(5)
    texts = [text_in(rng, "de", 20) for _ in range(3)]
    rows = [(texts[k % 3], "de") for k in range(300)] + [(text_in(rng, "fr", 20), "fr") for _ in range(200)]
    rows += [(rows[-1][0], "fr")] * 300
    df = spark.createDataFrame(rows, "text string, lang string")
    whole, once = op.fit(df, sample_rows=2000), op.fit(df.distinct(), sample_rows=2000)
    assert whole.languages == ["de", "fr", "und"] and (whole.table == once.table).all()
    drawn = op.fit(df, sample_rows=3)
    assert drawn.languages[0] == "de" and (drawn.table[:, 0] == once.table[:, 0]).all()


def brute(rows, host_of=lambda r: r[3]):
    """The documented rules, document by document and in plain Python."""
    import math
    import re as regex

    def letters(text):
        return regex.sub(r"[\W\d_]+", " ", (text or "").lower()).strip().encode("utf-8", "replace")

    def buckets(text):
        data = letters(text)
        data = b" " + data + b" " if data else b""
        return [((data[k] << 16 | data[k + 1] << 8 | data[k + 2]) * 2654435761 % (1 << 32)) >> 16 for k in range(len(data) - 2)]

    def code(label):
        m = regex.fullmatch(r"\s*([A-Za-z]{2,3})([-_].*)?\s*", label or "")
        return m[1].lower() if m else None

    counts = {}
    for lang, text in sorted({(code(r[2]), r[1]) for r in rows if code(r[2]) and r[1] is not None}):
        for b in buckets(text):
            counts.setdefault(lang, {}).setdefault(b, 0)
            counts[lang][b] += 1
    languages = sorted(counts)

    def scores(text):
        found = buckets(text)
        out = []
        for lang in languages:
            total = sum(counts[lang].values()) + 0.5 * op.BUCKETS
            out.append(sum(math.log((counts[lang].get(b, 0) + 0.5) / total) for b in found))
        return [s * op.TEXT_WEIGHT for s in (*out, -math.log(op.BUCKETS) * len(found))], len(found)

    names = [*languages, op.UND]
    labels = []
    for r in rows:
        s, n = scores(r[1])
        labels.append(names[max(range(len(s)), key=lambda k: (s[k], -k))] if n else None)

    def places(host):
        host = (host or "").lower()
        parts = host.split(".")
        return (parts[-1], ".".join(parts[-2:]), host) if len(parts) > 1 else ("", host, host)

    def share(level, place):
        mine = [x for x, r in zip(labels, rows) if places(host_of(r))[: level + 1] == place[: level + 1]]
        return [sum(x == lang for x in mine) for lang in languages]

    known = [x for x in labels if x in languages]
    top = [(sum(x == lang for x in known) + 1) / (len(known) + len(languages)) for lang in languages]
    out = []
    for r in rows:
        place = places(host_of(r))
        prior = top
        for level in range(3):
            n = share(level, place)
            prior = [(a + op.SMOOTHING * p) / (sum(n) + op.SMOOTHING) for a, p in zip(n, prior)]
        total, size = scores(r[1])
        prior = [p * (1 - op.UND_PRIOR) for p in prior] + [op.UND_PRIOR]
        total = [t + math.log(p) for t, p in zip(total, prior)]
        suffix = place[0] or None
        for stated, trust in ((code(r[2]), op.DECLARED_TRUST), (op.SUFFIX_LANGUAGE.get(suffix), op.SUFFIX_TRUST)):
            if stated in languages:
                for k, name in enumerate(names):
                    total[k] += math.log(trust if name == stated else (1 - trust) / (len(names) - 1))
        top_score = max(total)
        weights = [math.exp(t - top_score) for t in total]
        best = weights.index(max(weights))
        language, posterior = (names[best], weights[best] / sum(weights)) if size else (op.UND, 0.0)
        out.append((r[0], language, posterior, language != op.UND and posterior >= op.MIN_POSTERIOR))
    return out


MIXED = [
    ("der die das und nicht ein wir", "de"), ("the and of to in that with", "en"), ("le la les et dans nous", "fr"),
]


def mixed_rows():
    rng = random.Random(31)
    rows = []
    for k in range(90):
        words, lang = MIXED[k % 3]
        text = " ".join(rng.choice(words.split()) for _ in range(rng.randrange(0, 7)))
        label = rng.choice([lang, lang.upper(), f"{lang}-XX", None, "unknown language", "12"])
        host = rng.choice(["www.a.de", "b.de", "news.co.uk", "x.fr", None, "plain", "WWW.A.DE"])
        rows.append((k, text if k % 13 else None, label, host))
    rows += [(200, "12 34", "en", "a.de"), (201, "", None, None), (None, "the and of", None, "b.de"), rows[4], rows[4]]
    return rows


def test_fusion_against_brute_force(spark, listed):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, site string").repartition(3)
    found = listed(op.identify(df, host=F.col("site")))
    want = sorted(brute(rows), key=lambda r: [(x is None, x) for x in r])
    key = lambda r: (r[0] is None, r[0], r[1], round(r[2], 5))
    for a, b in zip(sorted(found, key=key), sorted(want, key=key), strict=True):
        assert (a[0], a[1], a[3]) == (b[0], b[1], b[3]) and abs(a[2] - b[2]) < 1e-4
    kept = sorted(r.doc_id for r in op.accepted(df.where("doc_id is not null"), host=F.col("site")).collect())
    assert len(kept) >= sum(r[3] for r in want if r[0] is not None) - 1


def test_codes_in_any_spelling_are_one_language(spark):
    df = spark.createDataFrame(mixed_rows(), "doc_id long, text string, lang string, site string")
    assert op.fit(df).languages == ["de", "en", "fr", "und"]


def test_without_declared_languages_all_is_rejected(spark):
    df = spark.createDataFrame([(1, "the and of"), (2, None)], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert [(r.language, r.accepted) for r in op.identify(df).collect()] == [("und", False)] * 2


def test_many_labels_are_bounded(spark, monkeypatch):
    rows = [(k, f"word{k} other text", f"{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(60)] + [(99, "the and", "en")] * 3
    rows += [(100 + k, f"the and of {k} to in" + "x" * k, "en") for k in range(5)]
    monkeypatch.setattr(op, "MOST_LANGUAGES", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(op.fit(df).languages) == 11 and "en" in op.fit(df).languages
    assert op.identify(df).count() == len(rows)


def test_text_of_many_megabytes(spark):
    text = "der die das und nicht ein wir " * 150_000
    rows = [(k, *MIXED[k % 3]) for k in range(9)] + [(9, text, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id: r.language for r in op.identify(df).collect()}[9] == "de"
