"""Repeated substrings by compressed FM-indexes over shards of candidate text.

1. Anchors. A window is WINDOW consecutive words; its anchor is the least hash among its runs
   of GRAM words. Windows with the same words have the same anchor, so what can repeat has an
   anchor that occurs twice. Consecutive windows with one anchor form a segment.
2. Candidates. Anchors are counted over the whole table; segments whose anchor occurs once are
   left out. Windows whose anchor is very frequent (at most HOT_ANCHORS such anchors exist) take
   the least of their other runs as anchor, so that a common line doesn't gather all that
   surrounds it in one place.
3. Shards. Segments are dealt by anchor and sorted. A task cuts its part, between anchors, into
   shards of about SHARD_WORDS words, each with an FM-index: the Burrows-Wheeler transform of
   the words in a wavelet matrix, its bit vectors with popcount ranks. A segment that occurs
   more often is there once, at its first place. The segments are streamed through it from right
   to left by backward search. The matching statistics are cut at the threshold: after each step
   the interval is widened to all rows that share WINDOW words, so every window costs one step.
   The earliest position in a window's interval is its first occurrence.
4. A window that starts later than its first occurrence is removed; runs are gathered per
   document, and the documents are cut.

The table's texts are dealt out once, by id; all later steps read that same exchange. Rows that share
an id (null is one) are first sorted by id, text and a random number over ranges and numbered there, so
that every row is a document of its own, however many rows an id has.

Defined results: a null or empty text has no words; documents are ordered by id (null first),
rows that share an id by text; an empty table gives an empty result. Texts of any length are hashed block
by block. Ids must be integers. Only the named columns are read.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..operators.lineage import checked_broadcast
from ..sources.stages import staged
from .text import utf8

WINDOW = 20
GRAM = 6
HOT_ANCHORS = 100_000
HOT_SEGMENTS = 1_000
SHARD_WORDS = 500_000
# Text bytes hashed at once.
BLOCK_BYTES = 1 << 20
NO_ID = -(1 << 63)
# Bytes of a word's hash in the index, and of an anchor.
HASH_BYTES = 6
# A place is (first window, windows) in one number; START is one window.
START = 1 << 7
# Windows in a segment; longer runs (text that repeats itself) are cut.
LONGEST = 64
GRAMS = WINDOW - GRAM + 1
# Sorting by this many words is enough for patterns of WINDOW + 1.
ORDER = 32

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text):
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8 bytes."""
    return utf8(text).split()


def _powers(base, n):
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = _powers(np.uint64(_BASE), BLOCK_BYTES)
_INVERSES = _powers(np.uint64(pow(_BASE, -1, 1 << 64)), BLOCK_BYTES)


def _mixed(x):
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _word_hashes(data, edges):
    """Start and 64-bit hash of every word of the texts that `edges` cut `data` into.

    A word's hash is a polynomial over its bytes: a difference of prefix sums, shifted back.
    """
    space = _IS_SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    inner = edges[:-1][edges[:-1] < len(data)]
    begins[inner] = ~space[inner]
    finishes = ~space
    finishes[:-1] &= space[1:]
    last = edges[1:][edges[1:] > edges[:-1]] - 1
    finishes[last] = ~space[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    hashes = np.zeros(len(starts), np.uint64)
    # Blocks begin with a word; a word longer than a block is summed up over several.
    word = 0
    while word < len(starts):
        low = starts[word]
        to = max(word + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, side="right")))
        for at in range(low, ends[to - 1], BLOCK_BYTES):
            upto = min(at + BLOCK_BYTES, ends[to - 1])
            sums = np.concatenate(
                [[np.uint64(0)], np.cumsum(_BYTE_VALUES[data[at:upto]] * _POWERS[: upto - at])]
            )
            part = sums[np.minimum(ends[word:to], upto) - at] - sums[np.maximum(starts[word:to], at) - at]
            shift = _INVERSES[np.maximum(starts[word:to], at) - at]
            hashes[word:to] = _mixed(hashes[word:to]) + part * shift
        word = to
    return starts, _mixed(hashes + (ends - starts).astype(np.uint64))


def groups(texts):
    """(first row, hashes of all words, text of each word) for rows of about BLOCK_BYTES bytes."""
    texts = texts.cast(pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else [0]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(edges, edges[row] + BLOCK_BYTES, side="right")) - 1)
        cut = edges[row : to + 1] - edges[row]
        starts, hashes = _word_hashes(data[edges[row] : edges[to]], cut)
        yield row, to, hashes, np.searchsorted(cut, starts, side="right") - 1
        row = to


def _gram_hashes(h):
    """Hash of each run of GRAM words."""
    n = len(h) - GRAM + 1
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = out * _FACTOR + h[k : k + n]
    return _mixed(out) >> np.uint64(64 - 8 * HASH_BYTES)


def _sliding_min(values, width):
    """Least of each run of `width` values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def segments(h, text=None, hot=None, chosen=None):
    """First window, number of windows and anchor of each segment of at most LONGEST windows.

    `text` numbers the text of every word; windows stay inside one, and, if `chosen` is given,
    are those that begin at a chosen word. `hot` (sorted) are anchors to avoid: they count as
    the largest value where another is at hand. Also returns the hash of every run of GRAM words.
    """
    if len(h) < WINDOW:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), empty
    grams = _gram_hashes(h)
    anchor = _sliding_min(grams, GRAMS)
    if hot is not None and len(hot):
        is_hot = _member(hot, anchor)
        if is_hot.any():
            other = _sliding_min(np.where(_member(hot, grams), _LAST, grams), GRAMS)
            anchor = np.where(is_hot & (other != _LAST), other, anchor)
    usable = np.ones(len(anchor), bool) if chosen is None else chosen[: len(anchor)]
    if text is not None:
        usable = usable & (text[: len(anchor)] == text[WINDOW - 1 :])
    windows = np.flatnonzero(usable)
    anchor = anchor[windows]
    place = np.arange(len(windows))
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    begun = np.maximum.accumulate(np.where(new, place, 0))
    first = np.flatnonzero((place - begun) % LONGEST == 0)
    return windows[first], np.diff(np.append(first, len(windows))), anchor[first], grams


def anchor_occurrences(starts, counts, anchors, grams):
    """How often each segment's anchor is among its runs: twice if a window may repeat inside."""
    if not len(starts):
        return starts
    sizes = counts + GRAMS - 1
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) + np.repeat(starts - begin, sizes)
    return np.add.reduceat((grams[place] == np.repeat(anchors, sizes)).astype(np.int64), begin)


def _member(ordered, values):
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


# Step 2: anchors and candidates.


def _count_anchors(batches):
    for batch in batches:
        for _, _, h, text in groups(batch.column("text")):
            found = segments(h, text)
            values, place = np.unique(found[2], return_inverse=True)
            sums = np.bincount(place, anchor_occurrences(*found), len(values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(sums)], names=["anchor", "n"]
            )


def _list_segments(batches):
    for batch in batches:
        key, copy = batch.column("key").to_numpy(), batch.column("copy").to_numpy()
        for row, to, h, text in groups(batch.column("text")):
            starts, counts, anchors, _ = segments(h, text)
            owner = text[starts]
            start = starts - np.searchsorted(text, np.arange(to - row))[owner]
            numbers = (key[row:to][owner], copy[row:to][owner], start * START + counts, anchors.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(n) for n in numbers], names=["key", "copy", "place", "anchor"]
            )


def _owners(batch):
    """Rows that the elements of the array `found` belong to."""
    return np.repeat(np.arange(len(batch)), np.diff(batch.column("found").offsets.to_numpy()))


def _shortened(h):
    """HASH_BYTES bytes of each hash."""
    return h.view(np.uint8).reshape(-1, 8)[:, -HASH_BYTES:].tobytes()


def _batch_of(rows, **kinds):
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds)
    )


def _name_segments(hot):
    """Every candidate segment with its anchor (not a hot one, where it can be) and digest."""

    def run(batches):
        for batch in batches:
            key, copy = batch.column("key").to_numpy(), batch.column("copy").to_numpy()
            place, owner = batch.column("found").flatten().to_numpy(), _owners(batch)
            for row, to, h, text in groups(batch.column("text")):
                here = slice(*np.searchsorted(owner, [row, to]))
                first_word = np.searchsorted(text, np.arange(to - row))
                start = first_word[owner[here] - row] + place[here] // START
                marks = np.zeros(len(h) + 1, np.int64)
                np.add.at(marks, start, 1)
                np.add.at(marks, start + place[here] % START, -1)
                starts, counts, anchors, _ = segments(h, text, hot.value, np.cumsum(marks[:-1]) > 0)
                raw, doc = _shortened(h), text[starts]
                names = [
                    xxhash.xxh128_digest(raw[w * HASH_BYTES : (w + n + WINDOW - 1) * HASH_BYTES])
                    for w, n in zip(starts.tolist(), counts.tolist())
                ]
                places = (starts - first_word[doc]) * START + counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[row:to][doc]),
                        pa.array(copy[row:to][doc]),
                        pa.array(places),
                        pa.array(anchors.view(np.int64)),
                        pa.array(names, pa.binary()),
                    ],
                    names=["key", "copy", "place", "anchor", "name"],
                )

    return run


def _cut_words(batches):
    """The word hashes of the first occurrence of every segment."""
    numbers = dict.fromkeys(("key", "copy", "place", "anchor"), pa.int64())
    kinds = numbers | dict(name=pa.binary(), words=pa.binary())
    for batch in batches:
        keys, copies = batch.column("key").to_pylist(), batch.column("copy").to_pylist()
        place, *fields = batch.column("found").flatten().flatten()
        owner, place = _owners(batch), place.to_numpy()
        for row, to, h, text in groups(batch.column("text")):
            low, high = np.searchsorted(owner, [row, to])
            base = np.searchsorted(text, np.arange(to - row))[owner[low:high] - row]
            first = (base + place[low:high] // START) * HASH_BYTES
            last = first + (place[low:high] % START + WINDOW - 1) * HASH_BYTES
            raw = _shortened(h)
            begins = place[low:high] // START * START
            columns = [c.tolist() for c in (owner[low:high], begins, first, last)]
            columns += [f.slice(low, high - low).to_pylist() for f in fields]
            rows = [(keys[r], copies[r], p, anchor, name, raw[a:b]) for r, p, a, b, anchor, name in zip(*columns)]
            yield _batch_of(rows, **kinds)


# Step 3: the index.


class BitVector:
    """Bits with constant-time rank."""

    def __init__(self, bits):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int32)[:-1]])

    def ones(self, ends):
        """Number of ones in [0, end) for each end."""
        at = ends >> 6
        mask = (np.uint64(1) << (ends & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence of small integers."""

    def __init__(self, symbols, n_symbols):
        self.levels = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift) & 1
            self.levels.append((shift, BitVector(bits.astype(np.uint8)), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def ranks(self, symbols, starts, ends):
        """Occurrences of each symbol in [0, start) and in [0, end)."""
        low = np.zeros(len(symbols), np.int64)
        for shift, vector, zeros in self.levels:
            one = ((symbols >> shift) & 1).astype(bool)
            n = len(symbols)
            ones = vector.ones(np.concatenate([low, starts, ends]))
            ones = (ones[:n], ones[n : 2 * n], ones[2 * n :])
            low, starts, ends = (
                np.where(one, zeros + o, x - o) for x, o in zip((low, starts, ends), ones)
            )
        return starts - low, ends - low


class FMIndex:
    """Index of a word sequence for patterns of up to WINDOW + 1 words."""

    def __init__(self, symbols, n_symbols):
        order, half = _suffix_order(symbols)
        previous = symbols[order - 1]
        self.matrix = WaveletMatrix(previous, n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.order = order
        # Rows that share WINDOW words form groups.
        shared = np.stack([half[order], half[(order + WINDOW - 16) % len(order)]])
        new = np.concatenate([[True], (shared[:, 1:] != shared[:, :-1]).any(axis=0)])
        self.group = np.cumsum(new) - 1
        self.group_start = np.append(np.flatnonzero(new), len(order))

    def extend(self, symbols, starts, ends):
        """Backward search: intervals of symbol + pattern from those of the patterns."""
        low, high = self.matrix.ranks(symbols, starts, ends)
        return self.first[symbols] + low, self.first[symbols] + high

    def widen(self, starts):
        """Interval of all rows that share WINDOW words with each row."""
        group = self.group[starts]
        return self.group_start[group], self.group_start[group + 1]


def _suffix_order(symbols):
    """Positions sorted by ORDER symbols (cyclically), and their ranks by 16 symbols."""
    rank, n = symbols.astype(np.int64), len(symbols)
    span, half, order = 1, None, None
    while span < ORDER:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -span)
        order = np.argsort(pair)
        ordered = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        span *= 2
        if span == 16:
            half = rank
    return order, half


def first_occurrences(texts, places):
    """For each window of each text, the least place of any text that has it, plus its offset.

    `texts` are arrays of word hashes, `places` sortable (document, start) numbers in one array.
    """
    lengths = np.array([len(t) for t in texts])
    n = len(texts)
    joined = np.concatenate(texts)
    _, ranks = np.unique(joined, return_inverse=True)
    # Symbol 0 ends each text; the sequence is cyclic, so the last end also precedes the first text.
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    symbols = np.zeros(int((lengths + 1).sum()), np.int64)
    inside = np.repeat(begin, lengths) + np.arange(len(joined)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    symbols[inside] = ranks + 1
    index = FMIndex(symbols, int(ranks.max()) + 2)
    owner = np.searchsorted(begin, index.order, side="right") - 1
    value = places[owner] + (index.order - begin[owner])
    least = np.minimum.reduceat(value, index.group_start[:-1])

    windows = lengths - WINDOW + 1
    out = [np.empty(w, np.int64) for w in windows]
    by_length = np.argsort(-lengths, kind="stable")
    starts = np.zeros(n, np.int64)
    ends = np.full(n, len(symbols), np.int64)
    for step in range(int(lengths.max())):
        # Texts that still have a word to the left, longest first.
        active = by_length[: np.searchsorted(-lengths[by_length], -step, side="left")]
        at = lengths[active] - 1 - step
        starts[active], ends[active] = index.extend(symbols[begin[active] + at], starts[active], ends[active])
        if step >= WINDOW - 1:
            starts[active], ends[active] = index.widen(starts[active])
            found = least[index.group[starts[active]]]
            for text, offset, place in zip(active.tolist(), at.tolist(), found.tolist()):
                out[text][offset] = place
    return out


def _search_shards(batches):
    names, places, texts, words, last = [], [], [], 0, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("anchor", "name", "key", "copy", "place", "words"))
        for anchor, name, key, copy, place, text in zip(*columns):
            if anchor != last and words >= SHARD_WORDS:
                yield from _shard(names, places, texts)
                names, places, texts, words = [], [], [], 0
            last = anchor
            names.append(name)
            places.append((key, copy, place))
            texts.append(text)
            words += len(text) // HASH_BYTES
    if names:
        yield from _shard(names, places, texts)


def _lengthened(text):
    wide = np.zeros((len(text) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = np.frombuffer(text, np.uint8).reshape(-1, HASH_BYTES)
    return wide.view(np.uint64)[:, 0]


def _shard(names, places, texts):
    """First occurrences per segment; none where its windows first occur in the segment itself."""
    documents = sorted({(key, copy) for key, copy, _ in places})
    number = {d: k for k, d in enumerate(documents)}
    own = np.array([(number[k, c] << 32) + p // START for k, c, p in places], np.int64)
    found = first_occurrences([_lengthened(t) for t in texts], own)
    document_keys, document_copies = np.array(documents, np.int64).T
    for at in range(0, len(names), 4096):
        rows = range(at, min(at + 4096, len(names)))
        elsewhere = [k if (found[k] != own[k] + np.arange(len(found[k]))).any() else None for k in rows]
        flat = np.concatenate([found[k] for k in elsewhere if k is not None] or [np.zeros(0, np.int64)])
        sizes = [0 if k is None else len(found[k]) for k in elsewhere]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        keys, copies = document_keys[flat >> 32], document_copies[flat >> 32]
        windows = (flat & 0xFFFFFFFF) * START
        own_keys, own_copies, own_places = zip(*(places[k] for k in rows))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names[at : at + 4096], pa.binary()),
                pa.array(own_keys, pa.int64()),
                pa.array(own_copies, pa.int64()),
                pa.array(own_places, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(keys)),
                pa.ListArray.from_arrays(offsets, pa.array(copies)),
                pa.ListArray.from_arrays(offsets, pa.array(windows)),
            ],
            names=["name", "own_key", "own_copy", "own_place", "keys", "copies", "places"],
        )


# Step 4: removal.


def _compare(batches):
    """Runs of words covered by windows that occur earlier."""
    for batch in batches:
        place = batch.column("place").to_numpy()
        n = place % START
        row = np.repeat(np.arange(len(n)), n)
        offset = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * START

        def first(own, listed, shift):
            out = batch.column(own).to_numpy()[row] + shift
            values = batch.column(listed)
            out[(np.diff(values.offsets.to_numpy()) > 0)[row]] = values.flatten().to_numpy()
            return out

        keys, copies = first("own_key", "keys", 0), first("own_copy", "copies", 0)
        places = first("own_place", "places", offset)
        key, copy = batch.column("key").to_numpy()[row], batch.column("copy").to_numpy()[row]
        place = (place - n)[row] + offset
        earlier = (copies < copy) | (copies == copy) & (places < place)
        later = (keys < key) | (keys == key) & earlier
        joined = later[:-1] & later[1:] & (row[1:] == row[:-1])
        begins = np.flatnonzero(later & ~np.concatenate([[False], joined])[: len(later)])
        ends = np.flatnonzero(later & ~np.concatenate([joined, [False]])[: len(later)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key[begins]),
                pa.array(copy[begins]),
                pa.array((place[begins] // START).astype(np.int32)),
                pa.array((place[ends] // START + WINDOW).astype(np.int32)),
            ],
            names=["key", "copy", "first", "last"],
        )


def _remove(digest):
    def run(batches):
        for batch in batches:
            total, removed, kept_texts = [], [], []
            for text, runs in zip(*(batch.column(c).to_pylist() for c in ("text", "runs"))):
                words = words_of(text)
                kept, at = [], 0
                for first, last in sorted((r["first"], r["last"]) for r in runs or ()):
                    if first > at:
                        kept += words[at:first]
                    at = max(at, last)
                kept += words[at:]
                total.append(len(words))
                removed.append(len(words) - len(kept))
                text = b" ".join(kept)
                kept_texts.append(
                    hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "surrogatepass")
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept_texts, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept"],
            )

    return run


def repeated_anchors(docs):
    """(anchor, n) of the anchors that occur more than once."""
    counted = docs.mapInArrow(_count_anchors, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")


def _numbered(docs, parts):
    """(key, copy, text) with a pair of its own for every row, in the order of id and text."""
    docs = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "text")
    repeated = checked_broadcast(docs.groupBy("key").count().where("count > 1").select("key"))
    # Always 0, but no constant, which the optimizer would take out of the exchange and the joins. Neither
    # number may be nullable, else the joins filter nulls first and no longer share the exchange.
    copy = F.coalesce(F.pmod("key", F.lit(1)), F.lit(0).cast("long")).alias("copy")
    alone = docs.join(repeated, "key", "left_anti").select("key", copy, "text")
    if repeated.isEmpty():
        return alone
    order = ["key", "text", "salt"]
    ordered = docs.join(repeated, "key").withColumn("salt", F.rand(0)).repartitionByRange(parts, *order)
    # These numbers rise with the range, then with the place in it.
    ordered = ordered.sortWithinPartitions(*order).withColumn("copy", F.monotonically_increasing_id())
    both = alone.unionByName(staged(ordered.select("key", "copy", "text"), "copies"))
    numbers = [F.coalesce(c, F.lit(other).cast("long")).alias(c) for c, other in (("key", NO_ID), ("copy", 0))]
    return both.select(*numbers, "text")


def dedupe(documents, id_col="doc_id", text_col="text", digest=False):
    """doc_id, n_words, n_removed, kept (the kept words, or their digest) of every document."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    anchors = staged(repeated_anchors(docs.select("text")), "anchors")
    total = anchors.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_SEGMENTS, total // HOT_ANCHORS)
    frequent = [r["anchor"] for r in anchors.where(F.col("n") > limit).select("anchor").collect()]
    hot = spark.sparkContext.broadcast(np.sort(np.array(frequent, np.int64).view(np.uint64)))

    # Every use reads the same columns, so that all share one exchange of the texts.
    document = ["key", "copy"]
    dealt = _numbered(docs, parts).repartition(parts, *document)
    listed = dealt.mapInArrow(_list_segments, "key long, copy long, place long, anchor long")
    found = listed.join(anchors.select("anchor"), "anchor", "left_semi").groupBy(*document).agg(
        F.collect_list("place").alias("found")
    )
    named = dealt.join(found, document).mapInArrow(
        _name_segments(hot), "key long, copy long, place long, anchor long, name binary"
    )
    chosen = (
        named.groupBy("name")
        .agg(F.min(F.struct("key", "copy", "place", "anchor")).alias("first"))
        .select("first.*", "name")
        .groupBy(*document)
        .agg(F.collect_list(F.struct("place", "anchor", "name")).alias("found"))
    )
    shards = (
        dealt.join(chosen, document)
        .mapInArrow(
            _cut_words, "key long, copy long, place long, anchor long, name binary, words binary"
        )
        .repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(
            _search_shards,
            "name binary, own_key long, own_copy long, own_place long, "
            "keys array<long>, copies array<long>, places array<long>",
        )
    )
    runs = (
        named.select("name", "key", "copy", "place")
        .join(shards, "name")
        .drop("name")
        .mapInArrow(_compare, "key long, copy long, first int, last int")
        .groupBy(*document)
        .agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    )
    return (
        dealt.join(runs, document, "left")
        .select(F.nullif("key", F.lit(NO_ID)).alias("doc_id"), "text", "runs")
        .mapInArrow(
            _remove(digest),
            f"doc_id long, n_words long, n_removed long, {'kept_sha256' if digest else 'kept'} string",
        )
    )


def report(documents):
    """doc_id, n_words, n_removed and the digest of the kept words."""
    return dedupe(documents, digest=True)
