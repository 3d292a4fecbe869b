"""Fill-in-the-middle transformation with a compressed set of token boundaries.

A text's tokens are runs of ASCII letters and single other characters. The offsets between them,
0 and the end of the text included, are kept in a set of containers, one for every 65,536
offsets: a sorted array, a bitmap or runs, whichever is smallest, with the number of members
before each container. The offset after k tokens is the k-th member: a binary search over the
cumulative cardinalities finds the container, a local select the member. Containers are built
from one slice of the text after the other, so a very long text costs no more than its set.

Where the cuts are and which form a document gets depend only on the seed, its id and its text:
no shuffle, and a lost task gives the same rows again.

Defined results: a null text is empty; an empty text, or one that holds a marker, stays plain;
a null id is hashed as an empty string; repeated rows give repeated results, and an empty table
none. Texts of any length are cut whole. Only the named columns are read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .text import utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Per cent of documents that are transformed, and of those in the form spm.
RATE = 90
SPM_RATE = 20
SEED = 1
CHUNK = 1 << 16


class ArrayContainer:
    """Sorted members."""

    def __init__(self, members):
        self.members = members.astype(np.uint16)
        self.size = len(members)
        self.nbytes = self.members.nbytes

    def select(self, k):
        return int(self.members[k])


class BitmapContainer:
    """One bit for every offset, with the number of ones before each word."""

    def __init__(self, members):
        bits = np.zeros(CHUNK, np.uint8)
        bits[members] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.size = int(self.before[-1])
        self.nbytes = self.words.nbytes

    def select(self, k):
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """First members of runs of consecutive ones, with the number of members before each run."""

    def __init__(self, members):
        new = np.flatnonzero(np.diff(members, prepend=members[0] - 2) != 1)
        self.firsts = members[new].astype(np.uint16)
        self.before = new
        self.size = len(members)
        self.nbytes = 4 * len(new)

    def select(self, k):
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.firsts[run]) + k - int(self.before[run])


def container(members):
    """The smallest container of sorted members below CHUNK."""
    runs = 1 + int(np.count_nonzero(np.diff(members) != 1))
    sizes = {ArrayContainer: 2 * len(members), BitmapContainer: CHUNK // 8, RunContainer: 4 * runs}
    return min(sizes, key=sizes.get)(members)


class Boundaries:
    """The offsets between the tokens of a text, its start and its end included."""

    def __init__(self, text):
        self.keys, self.containers, sizes = [], [], []
        for key in range(len(text) // CHUNK + 1):
            members = _boundaries(text, key * CHUNK)
            if len(members):
                self.keys.append(key)
                self.containers.append(container(members))
                sizes.append(self.containers[-1].size)
        self.ends = np.cumsum(sizes)

    def __len__(self):
        return int(self.ends[-1])

    def select(self, k):
        """The k-th smallest offset, from 0."""
        at = int(np.searchsorted(self.ends, k, side="right"))
        before = int(self.ends[at - 1]) if at else 0
        return self.keys[at] * CHUNK + self.containers[at].select(k - before)


def _boundaries(text, start):
    """The boundaries in [start, start + CHUNK), less `start`."""
    low = max(start - 1, 0)
    part = text[low : start + CHUNK].encode("utf-32-le", "surrogatepass")
    letter = ((np.frombuffer(part, "<u4") | 0x20) - np.uint32(97)) < 26
    left = letter[:-1] if start else np.concatenate([[False], letter[:-1]])
    right = letter[1:] if start else letter
    inner = ~(left & right)
    if start + len(inner) == len(text) and len(inner) < CHUNK:
        inner = np.append(inner, True)  # the end of the text
    if not start:
        inner[0] = True
    return np.flatnonzero(inner)


def _draws(seed, doc_id):
    """Four numbers of 32 bits."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def cut(text, doc_id, seed=SEED, rate=RATE, spm_rate=SPM_RATE):
    """Number of tokens, form, and the offsets where prefix and middle end (None if plain)."""
    offsets = Boundaries(text)
    tokens = len(offsets) - 1
    one, other, formed, order = _draws(seed, doc_id)
    if not text or any(m in text for m in MARKERS) or formed % 100 >= rate:
        return tokens, PLAIN, None, None
    one, other = one % (tokens + 1), other % (tokens + 1)
    form = SPM if order % 100 < spm_rate else PSM
    return tokens, form, offsets.select(min(one, other)), offsets.select(max(one, other))


def arranged(text, form, first, second):
    """The transformed text."""
    if form == PLAIN:
        return text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == SPM:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output, form):
    """The text that `arranged` was given; a text that holds a marker is never rearranged."""
    if form == PLAIN:
        return output
    opening, closing = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    one, _, rest = output.removeprefix(opening).partition(closing)
    other, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (other, one) if form == SPM else (one, other)
    return prefix + middle + suffix


def _sha256(text):
    return hashlib.sha256(utf8(text)).hexdigest()


def _run(seed, rate, spm_rate, digests):
    last = ("output_sha256", "restored_sha256") if digests else ("output",)

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                tokens, form, first, second = cut(text, doc_id, seed, rate, spm_rate)
                output = arranged(text, form, first, second)
                middle = None if first is None else second - first
                shown = (_sha256(output), _sha256(restored(output, form))) if digests else (output,)
                rows.append((tokens, form, first, middle, *shown))
            columns = zip(*rows) if rows else [[]] * (4 + len(last))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(last)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *last],
            )

    return run


def transform(
    documents, seed=SEED, rate=RATE, spm_rate=SPM_RATE, id_col="doc_id", text_col="text", digests=False
):
    """doc_id, n (tokens), form, prefix_chars, middle_chars, output of every document.

    With `digests`, the digests of the output and of the text rebuilt from it stand in for `output`.
    """
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shown = "output_sha256 string, restored_sha256 string" if digests else "output string"
    return docs.mapInArrow(
        _run(seed, rate, spm_rate, digests),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, {shown}",
    )


def report(documents):
    """Every document transformed, with the digests of its output and of the rebuilt text."""
    return transform(documents, digests=True)
