"""Language identification by Bayesian fusion of four kinds of evidence.

* Text: naive Bayes over hashed letter trigrams, fitted on a bounded sample of labelled rows. Declared
  codes count by their first part in lower case ("en-GB" and "EN" are "en"); labels that are no code of
  two or three letters are no evidence. Every such language with letters is learnt, however few its
  rows are, the MOST_LANGUAGES with the most different texts if there are more.
* Declared markup language: right with probability DECLARED_TRUST.
* Address suffix: a country suffix speaks for its languages with probability SUFFIX_TRUST.
* Host prior: language counts of the whole table, from the text alone, per suffix, domain and
  host; each level is smoothed by the one above it with the weight of SMOOTHING documents.

`und` (none of the known languages) competes with a flat trigram distribution. A document is
rejected if it has no letters, if `und` wins, or if the best language stays below MIN_POSTERIOR.

Defined results: a null or empty text has language `und`, posterior 0, and is rejected; a null
declared language, address or host is no evidence (a null host shares one prior); of equally likely
languages the first in alphabetical order wins, known ones before `und`; a table without any declared
language knows none, so all its rows are `und` and rejected; null ids and repeated rows pass through.
A very long text is scored in parts. Scores use named columns only; `accepted` keeps all columns.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import checked_broadcast
from ..sources.stages import staged

BUCKETS = 1 << 16
# Different texts of one language that the classifier is fitted on, in expectation.
SAMPLE_ROWS = 2000
MOST_LANGUAGES = 200
# Bytes of host priors that may be broadcast.
PRIOR_BYTES = 64 << 20
TEXT_WEIGHT = 0.5
DECLARED_TRUST = 0.9
SUFFIX_TRUST = 0.7
SMOOTHING = 10.0
UND_PRIOR = 0.01
MIN_POSTERIOR = 0.5
BYTES_AT_ONCE = 1 << 20
UND = "und"

# Country suffixes and a language spoken there (fixed values).
SUFFIX_LANGUAGE = {
    "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "it": "it",
    "pt": "pt", "br": "pt", "nl": "nl", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en",
}

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _letters(text):
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace") if text else b""


def _trigrams(data):
    """Bucket of every byte trigram."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    codes = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (codes * np.uint32(2654435761)) >> np.uint32(16)


class Model:
    """Log-likelihoods of trigram buckets per language."""

    def __init__(self, languages, counts):
        self.languages = [*languages, UND]
        smooth = counts + 0.5
        table = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        flat = np.full((1, BUCKETS), -np.log(BUCKETS))
        self.table = np.ascontiguousarray(np.vstack([table, flat]).T.astype(np.float32))

    def text_scores(self, texts):
        """(documents x languages) summed log-likelihoods and the number of trigrams."""
        scores = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            data = _letters(text)
            data = b" " + data + b" " if data else data
            for at in range(0, max(len(data) - 2, 0), BYTES_AT_ONCE):
                codes = _trigrams(data[at : at + BYTES_AT_ONCE + 2])
                scores[row] += self.table[codes].sum(axis=0, dtype=np.float64)
                sizes[row] += len(codes)
        return scores * TEXT_WEIGHT, sizes


def suffix_of(host):
    """Last label of a host name that has several."""
    return host.rpartition(".")[2].lower() if host and "." in host else None


def _evidence(languages, value, trust):
    """Log-likelihood of a stated language under each language."""
    k = len(languages)
    if value not in languages[:-1]:
        return np.zeros(k)
    other = (1 - trust) / max(k - 1, 1)
    return np.log([trust if x == value else other for x in languages])


def fuse(model, scores, sizes, declared, suffixes, priors):
    """Best language, its posterior and whether the document is accepted."""
    total = scores.copy()
    stated = {}
    for row, (d, s) in enumerate(zip(declared, suffixes)):
        if (d, s) not in stated:
            stated[d, s] = _evidence(model.languages, d, DECLARED_TRUST) + _evidence(
                model.languages, SUFFIX_LANGUAGE.get(s), SUFFIX_TRUST
            )
        total[row] += stated[d, s]
    total += np.log(priors)
    total -= total.max(axis=1, keepdims=True)
    posterior = np.exp(total)
    posterior /= posterior.sum(axis=1, keepdims=True)
    best = posterior.argmax(axis=1)
    names = np.array(model.languages, object)[best]
    value = posterior[np.arange(len(best)), best]
    empty = sizes == 0
    names[empty], value[empty] = UND, 0.0
    return names, value, (names != UND) & (value >= MIN_POSTERIOR)


def _code(label):
    """Language of a declared code, null if it is none."""
    code = F.lower(F.regexp_extract(label.cast("string"), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(code != "", code)


def _count_trigrams(batches):
    for batch in batches:
        found = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            data = _letters(text)
            if data:
                counts = np.bincount(_trigrams(b" " + data + b" "), minlength=BUCKETS)
                found[lang] = found[lang] + counts if lang in found else counts
        for lang, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["lang", "bucket", "n"],
            )


def fit(documents, label_col="lang", text_col="text", sample_rows=SAMPLE_ROWS):
    """Model from about `sample_rows` different texts of each declared language, chosen by hash."""
    rows = documents.select(_code(F.col(label_col)).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    different = rows.select("lang", F.xxhash64("text").alias("mark")).distinct()
    largest = different.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in largest.collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample_rows / sizes[k]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.where(F.col("lang").isin(languages)).where(draw < share[F.col("lang")]).distinct()
    counts = chosen.mapInArrow(_count_trigrams, "lang string, bucket int, n long")
    table = np.zeros((len(languages), BUCKETS))
    for r in counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[languages.index(r["lang"]), r["bucket"]] = r["n"]
    # Labels of texts without a letter name no language.
    learnt = np.flatnonzero(table.any(axis=1))
    return Model([languages[k] for k in learnt], table[learnt])


def _places(host):
    """Suffix, domain and host names, empty where there is none."""
    host = F.lower(F.coalesce(host, F.lit("")))
    labels = F.split(host, r"\.")
    many = F.size(labels) > 1
    suffix = F.when(many, F.element_at(labels, -1)).otherwise("")
    domain = F.when(many, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(host)
    return suffix.alias("suffix"), domain.alias("domain"), host.alias("host")


def _score(shared, extra):
    """Text scores, the best language by them, and whatever else the rows have."""

    def run(batches):
        model = shared.value
        names = np.array(model.languages, object)
        for batch in batches:
            scores, sizes = model.text_scores(batch.column("text").to_pylist())
            best = np.where(sizes > 0, names[scores.argmax(axis=1)], None)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * scores.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in extra),
                    pa.array(best, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(scores.reshape(-1))),
                    pa.array(sizes),
                ],
                names=[*extra, "label", "scores", "size"],
            )

    return run


def host_priors(documents, shared, host, text_col="text"):
    """(host, prior): smoothed language shares of each host, in the model's order."""
    rows = documents.select(*_places(host), F.col(text_col).alias("text"))
    extra = ["suffix", "domain", "host"]
    labels = rows.mapInArrow(
        _score(shared, extra),
        "suffix string, domain string, host string, label string, scores array<double>, size long",
    )
    return _priors(labels, shared.value.languages)


def _priors(labels, languages):
    """The priors by the labels of (suffix, domain, host, label) rows."""
    counts = [F.count(F.when(F.col("label") == x, 1)).alias(f"n{k}") for k, x in enumerate(languages)]
    hosts = staged(labels.groupBy("suffix", "domain", "host").agg(*counts), "hosts")
    names = [f"n{k}" for k in range(len(languages))]
    known = names[:-1]
    sums = [F.sum(n).alias(n) for n in names]
    total = hosts.agg(*sums).first()
    all_rows = sum(total[n] or 0 for n in known)
    top = [((total[n] or 0) + 1.0) / (all_rows + len(known)) for n in known]
    prior = {n: F.lit(p) for n, p in zip(known, top)}

    def smoothed(table, above):
        size = sum((F.col(n) for n in known), F.lit(0.0)) + SMOOTHING
        return table.withColumns({f"p_{n}": (F.col(n) + SMOOTHING * above(n)) / size for n in known})

    kept = [f"p_{n}" for n in known]
    by_suffix = smoothed(hosts.groupBy("suffix").agg(*sums), lambda n: prior[n]).select("suffix", *kept)
    by_domain = hosts.groupBy("suffix", "domain").agg(*sums).join(by_suffix, "suffix")
    by_domain = smoothed(by_domain, lambda n: F.col(f"p_{n}")).select("suffix", "domain", *kept)
    by_host = smoothed(hosts.join(by_domain, ["suffix", "domain"]), lambda n: F.col(f"p_{n}"))
    shares = [F.col(p) * (1 - UND_PRIOR) for p in kept]
    return staged(by_host.select("host", F.array(*shares, F.lit(UND_PRIOR)).alias("prior")), "priors")


def _known_hosts(priors, languages):
    """The priors, broadcast if their bytes allow it."""
    return checked_broadcast(priors, PRIOR_BYTES // (8 * len(languages) + 64))


def _fitted(documents, label_col, text_col, sample_rows, model):
    model = model or fit(documents, label_col or "lang", text_col, sample_rows)
    return documents.sparkSession.sparkContext.broadcast(model)


def _declared(label_col):
    return (_code(F.col(label_col)) if label_col else F.lit(None).cast("string")).alias("declared")


def _fused(model, batch, scores, sizes):
    priors = np.array(batch.column("prior").to_pylist(), float).reshape(len(batch), -1)
    declared, suffixes = batch.column("declared").to_pylist(), batch.column("suffix").to_pylist()
    return fuse(model, scores, sizes, declared, suffixes, priors)


def identify(
    documents, id_col="doc_id", text_col="text", label_col="lang", host=None,
    sample_rows=SAMPLE_ROWS, model=None,
):
    """(doc_id, language, posterior, accepted) for every row; `host` is a column or None.

    Texts are scored once; their scores, written as a stage, serve the priors and the fusion.
    """
    host = F.lit(None).cast("string") if host is None else host
    shared = _fitted(documents, label_col, text_col, sample_rows, model)
    languages = shared.value.languages
    rows = documents.select(
        F.col(id_col).alias("doc_id"), _declared(label_col), *_places(host), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    extra = ["doc_id", "declared", "suffix", "domain", "host"]
    scored = staged(
        rows.mapInArrow(
            _score(shared, extra),
            f"doc_id {kind}, declared string, suffix string, domain string, host string, "
            "label string, scores array<double>, size long",
        ),
        "scores",
    )
    joined = scored.drop("label", "domain").join(_known_hosts(_priors(scored, languages), languages), "host")

    def run(batches):
        for batch in batches:
            scores = np.array(batch.column("scores").to_pylist(), float).reshape(len(batch), -1)
            names, value, good = _fused(shared.value, batch, scores, batch.column("size").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(value), pa.array(good)],
                names=["doc_id", "language", "posterior", "accepted"],
            )

    return joined.mapInArrow(run, f"doc_id {kind}, language string, posterior double, accepted boolean")


def accepted(documents, text_col="text", label_col="lang", host=None, sample_rows=SAMPLE_ROWS, model=None):
    """The rows whose language is recognised, with all their columns."""
    host = F.lit(None).cast("string") if host is None else host
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    shared = _fitted(documents, label_col, text_col, sample_rows, model)
    priors = _known_hosts(host_priors(documents, shared, host, text_col), shared.value.languages)
    suffix, _, name = _places(host)
    rows = documents.select(whole, F.col(text_col).alias("text"), _declared(label_col), suffix, name)
    rows = rows.join(priors, "host")

    def run(batches):
        for batch in batches:
            scores, sizes = shared.value.text_scores(batch.column("text").to_pylist())
            good = _fused(shared.value, batch, scores, sizes)[2]
            yield batch.select(["row"]).filter(pa.array(good))

    kept = rows.mapInArrow(run, T.StructType([rows.schema["row"]]))
    return kept.select("row.*")


def report(documents):
    """Language, posterior and verdict of every document; its source is its host."""
    found = identify(documents, host=F.col("source"))
    return found.select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "accepted")
