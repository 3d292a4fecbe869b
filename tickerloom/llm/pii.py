"""Personal data: regular expressions propose spans, checksums confirm them, words nearby score.

Four base kinds (email, ip, card, phone) follow fixed rules and always stay. Further kinds are
proposed by looser patterns, confirmed by a checksum where there is one (mod-97 for bank
account numbers, Luhn for short card numbers), scored, raised or lowered by the words around
them, and kept from MIN_SCORE on if they don't overlap a base span.

Defined results: a null or empty text has no spans; ids, nulls and repeated rows pass through;
spans count code points, the end is exclusive. The patterns run in time linear in the text.
Only the named columns are read (`redact` keeps all columns), so others cannot clash.
"""

import re
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "iban", "short_card", "ssn", "local_phone"]
BASE = KINDS[:4]
MIN_SCORE = 0.5
CONTEXT_CHARS = 48

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A match never starts inside a run of digits, so looking behind changes no result.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[a-z]+")

# (kind, pattern, score before context, words that raise it by 0.3)
_FURTHER = [
    (
        "iban",
        re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
        0.7,
        {"iban", "account", "bank", "konto", "compte", "cuenta"},
    ),
    (
        "short_card",
        re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9]{4}[ -]?[0-9]{3}[ -]?[0-9]{3}[ -]?[0-9]{3}(?![ -]?[0-9])"),
        0.3,
        {"card", "visa", "credit", "debit", "karte", "carte", "tarjeta"},
    ),
    (
        "ssn",
        re.compile(r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"),
        0.4,
        {"ssn", "social", "security", "taxpayer"},
    ),
    (
        "local_phone",
        re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
        0.3,
        {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "handy", "movil"},
    ),
]
_LOWERING = {"order", "invoice", "isbn", "version", "serial", "ticket", "build", "example"}


def luhn(digits):
    """Whether a string of decimal digits passes the Luhn check."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account):
    """Whether an account number (country, check digits, rest) leaves 1 modulo 97."""
    plain = account.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text):
    at, free = text.find("@"), 0
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text):
    """(kind, start, end) of the base kinds, leftmost and non-overlapping per kind."""
    spans = [("email", s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def _context(text, start, end):
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    return set(_WORD.findall(around.lower()))


def _free(taken, start, end):
    """Whether no span of `taken` (disjoint, sorted) overlaps [start, end)."""
    at = bisect_left(taken, (end, 0))
    return at == 0 or taken[at - 1][1] <= start


def _disjoint(spans):
    out = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def further_spans(text, base):
    """(kind, start, end, score) of the other kinds that reach MIN_SCORE and touch no base span."""
    out, taken = [], _disjoint((s, e) for _, s, e, _ in base)
    for kind, pattern, score, raising in _FURTHER:
        for m in pattern.finditer(text):
            start, end = m.span()
            if not _free(taken, start, end):
                continue
            if kind == "iban" and not mod97(m[0]):
                continue
            if kind == "short_card" and not luhn(_NOT_DIGIT.sub("", m[0])):
                continue
            words = _context(text, start, end)
            value = score + 0.3 * bool(words & raising) - 0.2 * bool(words & _LOWERING)
            if value >= MIN_SCORE:
                out.append((kind, start, end, round(value, 2)))
                insort(taken, (start, end))
    return out


_BASE_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8}


def find(text):
    """All spans (kind, start, end, score) by start, then kind."""
    if not text:
        return []
    base = [(k, s, e, _BASE_SCORE[k]) for k, s, e in base_spans(text)]
    spans = base + (further_spans(text, base) if _DIGIT.search(text) else [])
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def masked(text, spans):
    """The text with every span (overlapping ones as one) replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def _scan(batches):
    for batch in batches:
        found = [
            [dict(zip(("kind", "start", "end", "score"), span)) for span in find(text)]
            for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, _SPANS)], names=["doc_id", "found"]
        )


def scan(documents, id_col="doc_id", text_col="text"):
    """(doc_id, found): an array of kind, start, end, score for every row."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "struct<kind:string,start:bigint,end:bigint,score:double>"
    return docs.mapInArrow(_scan, f"doc_id {kind}, found array<{span}>")


def redact(documents, text_col="text", size_col="n_chars"):
    """All rows and columns with the spans masked; `size_col`, if there, is brought up to date."""

    def run(batches):
        for batch in batches:
            old = batch.column(text_col).to_pylist()
            new = [t if t is None else masked(t, find(t)) for t in old]
            at = batch.schema.get_field_index(text_col)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            at = batch.schema.get_field_index(size_col)
            if at >= 0:
                sizes = [
                    len(b) if a != b else size
                    for a, b, size in zip(old, new, batch.column(at).to_pylist())
                ]
                field = batch.schema.field(at)
                batch = batch.set_column(at, field, pa.array(sizes, field.type))
            yield batch

    return documents.mapInArrow(run, documents.schema)


def report(documents):
    """Counts of the base kinds, the digest of their spans, and all spans as one string."""
    found = scan(documents)
    written = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("found", lambda s: s["kind"].isin(BASE))

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, BASE),
        F.sha2(F.array_join(F.transform(base, written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", written), ",").alias("spans"),
    )
