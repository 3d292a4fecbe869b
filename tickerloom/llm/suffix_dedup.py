"""Repeated byte strings by a suffix sort whose comparisons use hashes.

1. Anchors. A window is WINDOW bytes; its anchor is the least hash among its runs of GRAM bytes.
   Equal windows have equal anchors, so a window can only repeat if its anchor occurs twice.
   Consecutive windows with one anchor form a segment. Documents are dealt to units; each unit
   names an anchor once, with the number of its segments, so however common an anchor is, it
   comes once from a unit.
2. Names. Each unit gets back its anchors that occur twice and gives every segment of theirs a
   128-bit digest. A digest that comes again inside the unit repeats all its windows; the first
   of a unit goes on, and of those the first of all units stands for the digest. Windows whose
   anchor is very frequent (at most HOT_ANCHORS such anchors exist) take the least of their other
   runs; where all are frequent, the place of the anchor in the window parts them as well.
3. Suffix sort. Segments that share an anchor meet in one shard, one for each digest, and none
   that is alone. The suffixes at all windows of an anchor are sorted by their first WINDOW bytes:
   those that share their first eight bytes by a bottom-up mergesort, in the order of their places.
   Two suffixes are compared by binary search for their common extension over prefix polynomial
   hashes, then by the byte after it. All neighbours are compared byte by byte in the end; if a
   hash collision misled a comparison, the shard is sorted anew with another base.
   Suffixes that share WINDOW bytes are neighbours, the first occurrence first.
4. Windows that start later than their first occurrence are removed; runs of them are gathered
   by unit, and the documents are cut there.

The texts are dealt out once; all later steps read that same exchange. The segments of step 2 are
written as a stage, from which lost work is done again.

Defined results: a null or empty text has no bytes; documents are ordered by id (null first), rows
that share an id by text, and every row is a document of its own. Texts of any length are worked on
in blocks that overlap by a window. An empty table gives an empty result. Ids must be integers.
Only the named columns are read.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.stages import staged
from .substring_dedup import NO_ID, _numbered

WINDOW = 100
GRAM = 32
HOT_ANCHORS = 100_000
HOT_SEGMENTS = 1_000
# Units for each shuffle partition.
UNITS = 8
# Windows looked at together; places in a block take PLACE_BITS bits of a key.
BLOCK = 1 << 18
PLACE_BITS = 19
# Windows in a segment; longer runs (text that repeats itself) are cut.
LONGEST = WINDOW
# Bytes of the segments that are sorted together; the segments of one anchor are never parted.
SHARD_BYTES = 1 << 21
# Pairs of suffixes that are compared byte by byte at once.
VERIFIED = 1 << 16
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_BYTE_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_PLACE = np.uint64((1 << PLACE_BITS) - 1)
_SHIFT = np.uint64(PLACE_BITS)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x):
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# Step 1: windows, anchors, segments.


def gram_keys(data):
    """For each run of GRAM bytes its hash, with its place in the low bits."""
    hashes, span = _BYTE_VALUES[data], 1
    factor = BASES[0]
    while span < GRAM:
        hashes = hashes[:-span] * np.uint64(factor) + hashes[span:]
        factor, span = factor * factor % (1 << 64), 2 * span
    return (_mixed(hashes) & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)


def least(values, width):
    """Least of each run of `width` values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Block:
    """Windows of consecutive texts of a batch: their bytes, texts and segments."""

    def __init__(self, data, text, usable, offset):
        # `text` numbers the text of each window, `offset` is the place of the first in its text.
        self.data, self.text, self.usable, self.offset = data, text, usable, offset
        self.grams = gram_keys(data)
        self.keys = least(self.grams, WINDOW - GRAM + 1)
        self.anchors = self.keys >> _SHIFT

    def segments(self):
        """First window, windows, anchor, and whether the anchor is at several places."""
        windows = np.flatnonzero(self.usable)
        if not len(windows):
            return windows, windows, self.anchors[:0], self.usable[:0]
        anchor = self.anchors[windows]
        new = np.ones(len(windows), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
        new[1:] |= self.text[windows[1:]] != self.text[windows[:-1]]
        place = np.arange(len(windows))
        begun = np.maximum.accumulate(np.where(new, place, 0))
        first = np.flatnonzero((place - begun) % LONGEST == 0)
        last = np.append(first[1:], len(windows)) - 1
        several = self.keys[windows[first]] != self.keys[windows[last]]
        return windows[first], last - first + 1, anchor[first], several

    def keep(self, first, sizes):
        """From now on only the windows of these segments."""
        marks = np.zeros(len(self.usable) + 1, np.int8)
        np.add.at(marks, first, 1)
        np.add.at(marks, first + sizes, -1)
        self.usable = np.cumsum(marks[:-1], dtype=np.int8) > 0

    def avoid(self, hot):
        """Give windows with a frequent anchor another one, where there is one."""
        frequent = _Members(hot)
        met = frequent.contains(self.anchors) & self.usable
        if not met.any():
            return
        grams = np.where(frequent.contains(self.grams >> _SHIFT), _LAST, self.grams)
        other = least(grams, WINDOW - GRAM + 1)
        chosen = met & (other != _LAST)
        # The place of the anchor in the window depends on the window alone.
        place = (self.keys & _PLACE).astype(np.int64) - np.arange(len(self.keys))
        parted = _mixed(self.anchors + (place >> 3).astype(np.uint64) * np.uint64(BASES[1])) >> _SHIFT
        self.anchors = np.where(chosen, other >> _SHIFT, np.where(met, parted, self.anchors))
        self.keys = np.where(chosen, other, self.keys)


class _Members:
    """Membership in a small sorted set; most values are refused by their low bits."""

    def __init__(self, ordered):
        self.ordered = ordered
        self.marks = np.zeros(1 << 16, bool)
        self.marks[ordered & np.uint64(0xFFFF)] = True

    def contains(self, values):
        out = self.marks[values & np.uint64(0xFFFF)]
        at = np.flatnonzero(out)
        out[at] = _is_in(self.ordered, values[at])
        return out


def _is_in(ordered, values):
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def blocks(texts):
    """The blocks of a column of texts; `text` counts its rows."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    for low in range(int(edges[0]), int(edges[-1]), BLOCK):
        windows = min(BLOCK, int(edges[-1]) - low - WINDOW + 1)
        if windows <= 0:
            break
        rows = np.arange(*np.searchsorted(edges, [low, low + windows - 1], side="right") - [1, 0])
        # Windows of each row that begin here, and those of them that end inside it.
        begin = np.maximum(edges[rows], low) - low
        end = np.minimum(edges[rows + 1] - low, windows)
        text = np.repeat(rows, end - begin)
        usable = np.arange(windows) <= np.repeat(edges[rows + 1] - low - WINDOW, end - begin)
        yield Block(data[low : low + windows + WINDOW - 1], text, usable, low - edges)


def _list_anchors(batches):
    """(anchor, unit, n): every anchor once for each unit."""
    found = {}
    for batch in batches:
        units = batch.column("unit").to_numpy()
        for block in blocks(batch.column("text")):
            first, _, anchors, several = block.segments()
            owner = units[block.text[first]]
            for unit in np.unique(owner).tolist():
                mine = owner == unit
                values, place = np.unique(anchors[mine], return_inverse=True)
                counts = np.bincount(place, 1 + several[mine], len(values)).astype(np.int64)
                found.setdefault(unit, []).append((values, counts))
    for unit, parts in found.items():
        values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([n for _, n in parts]), len(values)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), pa.array(np.full(len(values), unit, np.int64)), pa.array(counts)],
            names=["anchor", "unit", "n"],
        )


# Step 2: names.

NAMED = "unit long, key long, copy long, start long, last long, anchor long, several boolean, name binary"


def _merged(key, copy, start, last):
    """Runs [start, last) of bytes, overlapping ones joined."""
    order = np.lexsort((start, copy, key))
    key, copy, start, last = (x[order] for x in (key, copy, start, last))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (copy[1:] != copy[:-1])
    # The furthest end of the runs so far, over one document.
    document = np.cumsum(new) * (last.max(initial=0) + 1)
    furthest = np.maximum.accumulate(document + last) - document
    new[1:] |= start[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    end = np.append(first, len(key))[1:] - 1
    return key[first], copy[first], start[first], furthest[end]


def _name(hot):
    """The first segment of every digest of a unit; runs, without a name, for all others."""

    def run(texts, listed):
        wanted = np.sort(listed.column("anchor").to_numpy()).view(np.uint64)
        columns = [[] for _ in range(8)]
        for batch in texts.to_batches() if len(wanted) else []:
            keys, copies = batch.column("key").to_numpy(), batch.column("copy").to_numpy()
            for block in blocks(batch.column("text")):
                first, sizes, anchors, _ = block.segments()
                known = _is_in(wanted, anchors)
                block.keep(first[known], sizes[known])
                if len(hot.value):
                    block.avoid(hot.value)
                first, sizes, anchors, several = block.segments()
                raw = memoryview(block.data)
                digests = b"".join(
                    xxhash.xxh128_digest(raw[a:b])
                    for a, b in zip(first.tolist(), (first + sizes + WINDOW - 1).tolist())
                )
                text = block.text[first]
                start = first + block.offset[text]
                halves = np.frombuffer(digests, np.uint64).reshape(-1, 2)
                row = (keys[text], copies[text], start, start + sizes + WINDOW - 1, anchors, several, *halves.T)
                for column, part in zip(columns, row):
                    column.append(part)
        if not columns[0]:
            return _named_table(listed, [np.zeros(0, np.int64)] * 4)
        key, copy, start, last, anchor, several, one, other = map(np.concatenate, columns)
        order = np.lexsort((start, copy, key, other, one))
        again = np.zeros(len(order), bool)
        again[1:] = (one[order][1:] == one[order][:-1]) & (other[order][1:] == other[order][:-1])
        runs = _merged(*(x[order[again]] for x in (key, copy, start, last)))
        order = order[~again]
        names = np.stack([one[order], other[order]], axis=1).tobytes()
        return _named_table(
            listed,
            [np.concatenate([x[order], r]) for x, r in zip((key, copy, start, last), runs)],
            anchor[order].view(np.int64).tolist(),
            several[order].tolist(),
            [names[k : k + 16] for k in range(0, len(names), 16)],
        )

    return run


def _named_table(listed, numbers, anchors=(), several=(), names=()):
    n = len(numbers[0])
    unit = listed.column("unit")[0].as_py() if len(listed) else 0
    rest = [None] * (n - len(names))
    return pa.Table.from_arrays(
        [
            pa.array(np.full(n, unit, np.int64)),
            *(pa.array(x.astype(np.int64)) for x in numbers),
            pa.array([*anchors, *rest], pa.int64()),
            pa.array([*several, *rest], pa.bool_()),
            pa.array([*names, *rest], pa.binary()),
        ],
        names=["unit", "key", "copy", "start", "last", "anchor", "several", "name"],
    )


# Step 3: the suffix sort.


def _cut_segments(texts, chosen):
    """The bytes of the chosen segments of a unit."""
    place = {}
    for k, doc in enumerate(zip(chosen.column("key").to_pylist(), chosen.column("copy").to_pylist())):
        place.setdefault(doc, []).append(k)
    start, last = chosen.column("start").to_pylist(), chosen.column("last").to_pylist()
    rows, parts = [], []
    for batch in texts.to_batches() if place else []:
        column = batch.column("text")
        for row, doc in enumerate(zip(batch.column("key").to_pylist(), batch.column("copy").to_pylist())):
            mine = place.get(doc)
            if mine:
                text = memoryview(column[row].as_buffer())
                rows += mine
                parts += [bytes(text[start[k] : last[k]]) for k in mine]
    found = chosen.select(["anchor", "key", "copy", "start"]).take(pa.array(rows, pa.int64()))
    return found.append_column("bytes", pa.array(parts, pa.binary()))


class Suffixes:
    """Sorts suffixes of a byte string by their first WINDOW bytes."""

    def __init__(self, data, base):
        self.data = data
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), base, np.uint64)]))
        inverse = np.uint64(pow(base, -1, 1 << 64))
        self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), inverse, np.uint64)]))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUES[data] * powers[:-1])])

    def common(self, a, b):
        """Length of the common extension of each pair of suffixes, at most WINDOW."""
        sums, inverses = self.sums, self.inverses
        low_a, low_b, shift_a, shift_b = sums[a], sums[b], inverses[a], inverses[b]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), WINDOW)
        for _ in range(WINDOW.bit_length()):
            middle = (low + high + 1) >> 1
            equal = (sums[a + middle] - low_a) * shift_a == (sums[b + middle] - low_b) * shift_b
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return np.minimum(low, WINDOW)

    def compare(self, a, b):
        """-1, 0 or 1 for each pair."""
        size = self.common(a, b)
        inside = np.minimum(size, WINDOW - 1)
        order = np.sign(self.data[a + inside].astype(np.int64) - self.data[b + inside])
        return np.where(size == WINDOW, 0, order)

    def sort(self, order, start, end):
        """Sort each class [start, end) of slots of `order` by merging runs; equal ones keep their order."""
        slots, width = np.arange(len(order)), 1
        while True:
            run = (slots - start) // width
            sibling = start + (run ^ 1) * width
            active = np.flatnonzero((end - start > width) & (sibling < end))
            if not len(active):
                return order
            mine, right = order[active], (run[active] & 1).astype(bool)
            low = sibling[active]
            high = np.minimum(low + width, end[active])
            at, open_ = low.copy(), np.arange(len(active))
            while len(open_):
                middle = (at[open_] + high[open_]) >> 1
                sign = self.compare(order[middle], mine[open_])
                before = (sign < 0) | ((sign == 0) & right[open_])
                at[open_[before]] = middle[before] + 1
                high[open_[~before]] = middle[~before]
                open_ = open_[at[open_] < high[open_]]
            merged = order.copy()
            pair = start[active] + (run[active] >> 1) * 2 * width
            merged[pair + (active - start[active] - run[active] * width) + (at - low)] = mine
            order, width = merged, 2 * width

    def neighbours(self, a, b):
        """Whether each pair shares WINDOW bytes; None if a pair isn't in the order of its bytes."""
        wide = np.lib.stride_tricks.sliding_window_view(self.data, WINDOW)
        out = np.zeros(len(a), bool)
        for at in range(0, len(a), VERIFIED):
            one, other = wide[a[at : at + VERIFIED]], wide[b[at : at + VERIFIED]]
            differ = one != other
            first = differ.argmax(axis=1)
            rows = np.arange(len(one))
            out[at : at + VERIFIED] = equal = ~differ[rows, first]
            if not (equal | (one[rows, first] < other[rows, first])).all():
                return None
        return out


def repeated_windows(data, starts, groups, bases=BASES):
    """Which windows of `data` equal an earlier one of their group; `starts` are in the order of places."""
    head = np.lib.stride_tricks.sliding_window_view(data, 8)[starts].copy().view(">u8")[:, 0]
    by_head = np.lexsort((head, groups))
    new = np.ones(len(starts), bool)
    new[1:] = (groups[by_head][1:] != groups[by_head][:-1]) | (head[by_head][1:] != head[by_head][:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(starts)))
    # Suffixes that are alone with their first bytes are in place.
    shared = np.repeat(sizes > 1, sizes)
    by_head, sizes = by_head[shared], sizes[sizes > 1]
    again = np.zeros(len(starts), bool)
    if not len(sizes):
        return again
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    end = begin + np.repeat(sizes, sizes)
    number = np.full(len(data), -1, np.int64)
    number[starts] = np.arange(len(starts))
    for base in bases:
        suffixes = Suffixes(data, base)
        order = suffixes.sort(starts[by_head], begin, end)
        inner = np.flatnonzero(begin[1:] == begin[:-1])
        equal = suffixes.neighbours(order[inner], order[inner + 1])
        if equal is not None:
            again[number[order[inner[equal] + 1]]] = True
            return again
    raise RuntimeError("hash collisions with every base")


def _sort_shards(batches):
    rows, size, last = [], 0, None
    names = ("anchor", "key", "copy", "start", "bytes")
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if row[0] != last and size >= SHARD_BYTES:
                yield _shard(rows)
                rows, size = [], 0
            last = row[0]
            rows.append(row)
            size += len(row[4])
    if rows:
        yield _shard(rows)


def _shard(rows):
    """Runs of windows that occur earlier, for the sorted segments of whole anchors."""
    anchors, keys, copies, places, parts = zip(*sorted(rows, key=lambda r: r[:4]))
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes) - sizes
    windows = sizes - WINDOW + 1
    segment = np.repeat(np.arange(len(parts)), windows)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    _, group = np.unique(np.array(anchors, np.int64), return_inverse=True)
    data = np.frombuffer(b"".join(parts), np.uint8)
    again = repeated_windows(data, begin[segment] + offset, group[segment])
    segment, offset = segment[again], offset[again]
    start = np.array(places, np.int64)[segment] + offset
    found = _merged(
        np.array(keys, np.int64)[segment], np.array(copies, np.int64)[segment], start, start + WINDOW
    )
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["key", "copy", "start", "last"])


# Step 4: removal.


def _remove(digest):
    kept_kind = pa.string() if digest else pa.binary()

    def run(texts, runs):
        columns = (runs.column(c).to_numpy() for c in ("key", "copy", "start", "last"))
        place = {}
        for key, copy, start, last in zip(*(x.tolist() for x in _merged(*columns))):
            place.setdefault((key, copy), []).append((start, last))
        names = ["key", "n_bytes", "n_removed", "n_spans", "kept"]
        rows = []
        for batch in texts.to_batches():
            column = batch.column("text")
            for row, doc in enumerate(zip(batch.column("key").to_pylist(), batch.column("copy").to_pylist())):
                text = memoryview(column[row].as_buffer()) if column[row].is_valid else b""
                mine = place.get(doc, ())
                edges = [0, *(x for r in mine for x in r), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                shown = hashlib.sha256(kept).hexdigest() if digest else kept
                rows.append((doc[0], len(text), len(text) - len(kept), len(mine), shown))
        columns = zip(*rows) if rows else [[]] * 5
        kinds = [pa.int64()] * 4 + [kept_kind]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _beside(texts, other, function, schema):
    """`function` of the texts and the other rows of each unit."""
    return texts.groupBy("unit").cogroup(other.groupBy("unit")).applyInArrow(function, schema)


def dedupe(documents, id_col="doc_id", text_col="text", digest=False):
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes, or their digest) of every document."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit = F.pmod(F.xxhash64("key", "copy"), F.lit(parts * UNITS)).alias("unit")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = _numbered(docs, parts).select(unit, "key", "copy", "text").repartition(parts, "unit")

    listed = dealt.mapInArrow(_list_anchors, "anchor long, unit long, n long")
    total = F.sum("n").over(Window.partitionBy("anchor"))
    anchors = staged(listed.withColumn("total", total).where("total > 1"), "anchors")
    limit = max(HOT_SEGMENTS, (anchors.agg(F.sum("n")).first()[0] or 0) // HOT_ANCHORS)
    frequent = anchors.where(F.col("total") > limit).select("anchor").distinct().collect()
    hot = spark.sparkContext.broadcast(np.sort(np.array([r.anchor for r in frequent], np.int64).view(np.uint64)))

    named = staged(_beside(dealt, anchors.select("unit", "anchor"), _name(hot), NAMED), "segments")
    run = ["key", "copy", "start", "last"]
    order = Window.partitionBy("name").orderBy("key", "copy", "start")
    ranked = named.where("name IS NOT NULL").withColumn("nth", F.row_number().over(order))
    by_anchor = Window.partitionBy("anchor")
    chosen = (
        ranked.where("nth = 1")
        .select("unit", "anchor", *run, "several")
        .withColumn("segments", F.count(F.lit(1)).over(by_anchor))
        .where("segments > 1 OR several")
        .select("unit", "anchor", *run)
    )
    sorted_runs = (
        _beside(dealt, chosen, _cut_segments, "anchor long, key long, copy long, start long, bytes binary")
        .repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_sort_shards, "key long, copy long, start long, last long")
    )
    runs = (
        named.where("name IS NULL").select("unit", *run)
        .unionByName(ranked.where("nth > 1").select("unit", *run))
        .unionByName(sorted_runs.select(unit, *run))
    )
    kind = "string" if digest else "binary"
    cut = _beside(dealt, runs, _remove(digest), f"key long, n_bytes long, n_removed long, n_spans long, kept {kind}")
    shown = "kept_sha256" if digest else "kept"
    return cut.select(
        F.nullif("key", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("kept").alias(shown)
    )


def report(documents):
    """doc_id, n_bytes, n_removed, n_spans and the digest of the remaining bytes."""
    return dedupe(documents, digest=True)
