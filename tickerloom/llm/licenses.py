"""Licence scan by canonical digest lookup, on DataFrame functions alone.

A text is made canonical: lower case, copyright lines dropped, every run of other characters
than letters and digits one space, equivalent spellings made one. Its SHA-256 is joined, by a
broadcast of a fixed table, to the digests of known licences. A whole text matches `license`;
single lines that are a known notice are listed in `notices`.

Defined results: a null text, or one without letters or digits, has no digest and no licence;
null ids and repeated rows pass through, and an empty table gives an empty result. Texts are made
canonical whole, by expressions, so a very long one costs a few copies of it. Only the named columns are
read.
"""

import hashlib
from functools import reduce

from pyspark.sql import functions as F

# Equivalent words of the SPDX matching guidelines.
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

_COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
_OTHER = r"[^\p{L}\p{N}]+"
_ANY_EQUIVALENT = f" (?:{'|'.join(word for word, _ in EQUIVALENT)}) "


def spaced(text):
    """Lower-case words of a text column, with two spaces between them: neighbours share none."""
    out = F.regexp_replace(F.lower(text), _COPYRIGHT_LINE, "\n")
    return F.concat(F.lit(" "), F.regexp_replace(out, _OTHER, "  "), F.lit(" "))


def canonical(words):
    """Canonical form of a `spaced` column; null if nothing is left of it."""
    same = reduce(lambda c, p: F.replace(c, F.lit(f" {p[0]} "), F.lit(f" {p[1]} ")), EQUIVALENT, words)
    # Few texts have any of the words; one search spares the others the replacements.
    out = F.when(F.rlike(words, F.lit(_ANY_EQUIVALENT)), same).otherwise(words)
    out = F.trim(F.replace(out, F.lit("  "), F.lit(" ")))
    return F.when(out != "", out)


def digest(words):
    return F.sha2(canonical(words), 256)


# SHA-256 of the canonical texts of licences.
DIGESTS = [
    ("Apache-2.0", "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100"),
    ("Apache-2.0", "e9dbf930ca0f1e090ec68da9a37b657d11bc9e43b30643455d6a96dbf73116ca"),
    ("Apache-2.0", "7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7"),
    ("Artistic-1.0-Perl", "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304"),
    ("BSD-2-Clause", "bb8d5167f37272384441ac2148c59da24c839b381820871d431b344c14921eed"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSL-1.0", "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("GFDL-1.2", "37db86be8f16e9b8dfb0d63e1698ad2e07d54f312494c1cb2dbdb4fa37487f0f"),
    ("GFDL-1.3", "7befa86e5ee53162018d597eee81db6c727f3e64fab4641af93e19deab1807b4"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-3.0", "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f"),
    ("ISC", "3389114824f5880ac1f9a7af2cd0c8d6ab15e6c7a1bd28ce4ebf00852cec9e8e"),
    ("LGPL-2.0", "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3"),
    ("LGPL-2.1", "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MPL-1.1", "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
    ("Unlicense", "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
]

# Canonical names of licences as notices give them.
NAMES = [
    ("Apache-2.0", "apache license version 2 0"),
    ("Apache-2.0", "apache license 2 0"),
    ("BSD-2-Clause", "bsd 2 clause license"),
    ("BSD-3-Clause", "bsd 3 clause license"),
    ("CC-BY-4.0", "cc by 4 0"),
    ("CC-BY-NC-4.0", "cc by nc 4 0"),
    ("CC-BY-SA-4.0", "cc by sa 4 0"),
    ("GPL-2.0", "gnu general public license version 2"),
    ("GPL-3.0", "gnu general public license version 3"),
    ("ISC", "isc license"),
    ("LGPL-3.0", "gnu lesser general public license version 3"),
    ("MIT", "mit license"),
    ("MPL-2.0", "mozilla public license version 2 0"),
]
FORMS = ["licensed", "released", "distributed", "this work is licensed", "this project is licensed"]
# Every notice of this rule matches it, also before spellings are made one.
NOTICE_MARK = r"(?is)licen|under.*cc"


def notices():
    """(licence, digest) of every form with every name, with and without an article."""
    lines = [(k, f"{form} under {the}{n}") for k, n in NAMES for form in FORMS for the in ("", "the ")]
    return [(k, hashlib.sha256(t.encode()).hexdigest()) for k, t in lines]


def known_texts(spark):
    """(license, digest): a fixed table."""
    rows = [F.struct(F.lit(k).alias("license"), F.lit(d).alias("digest")) for k, d in DIGESTS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(documents, id_col="doc_id", text_col="text"):
    """(doc_id, digest, license, notices): the licence that the whole text is, and notice lines."""
    text = F.col(text_col)
    by_digest = F.create_map(*[F.lit(x) for k, d in notices() for x in (d, k)])
    marked = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(NOTICE_MARK)))
    named = F.transform(marked, lambda line: F.element_at(by_digest, digest(spaced(line))))
    found = F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isNotNull())))
    # Read more than once below, so Spark works it out once, in a projection of its own.
    docs = documents.select(
        F.col(id_col).alias("doc_id"), spaced(text).alias("words"), found.alias("notices")
    ).select("doc_id", digest(F.col("words")).alias("digest"), "notices")
    known = F.broadcast(known_texts(documents.sparkSession))
    return docs.join(known, "digest", "left").select("doc_id", "digest", "license", "notices")


def report(documents):
    return scan(documents).withColumn("notices", F.coalesce(F.array_join("notices", ","), F.lit("")))
