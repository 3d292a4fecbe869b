"""Benchmark decontamination: Wu-Manber search of benchmark windows in document words.

The alphabet is words, so a pattern is a window of benchmark words and a block is two
consecutive words. For each pattern length a shift table says how far the search may
jump after seeing a block; a block that ends some pattern has shift 0 and selects, by its
hash and that of the pattern's first block, the patterns to compare directly.

Defined results: a null or empty text has no words and is clean; a null id stays null;
repeated rows are judged one by one; an item without words has no window; items that
share an id are one item, and an item without an id is named by the empty string. Only the
named columns are read, so other columns cannot clash. Texts are searched whole, one at a time, so a
very long one costs its words and their spans.
"""

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from ..sources.stages import staged
from .text import UPPER_TO_LOWER, utf8

WINDOW = 10
BLOCK = 2
# Benchmark windows (one begins at nearly every word) searched for in one pass, and their characters;
# a larger benchmark takes several passes.
WORDS_PER_PASS = 200_000
CHARS_PER_PASS = 100_000_000

_WORD_BYTES = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_SPACED = bytes(
    UPPER_TO_LOWER[b] if UPPER_TO_LOWER[b] in _WORD_BYTES else 0x20 for b in range(256)
)

FOUND = "doc_id {id}, text_key string, n_words long, covered array<array<int>>, items array<string>"


def words_of(text):
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z, as UTF-8 bytes."""
    return utf8(text).translate(_SPACED).split()


def windows_of(words, size=WINDOW):
    """All runs of `size` words; a shorter item is one window."""
    if len(words) <= size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


class WuManber:
    """Search for patterns of one length."""

    def __init__(self, patterns, length):
        self.length = length
        self.block = block = min(BLOCK, length)
        self.farthest = length - block + 1
        self.shift = {}
        self.buckets = {}
        for pattern in patterns:
            for end in range(block, length + 1):
                seen = pattern[end - block : end]
                if self.shift.get(seen, self.farthest) > length - end:
                    self.shift[seen] = length - end
            bucket = self.buckets.setdefault(pattern[length - block :], {})
            bucket.setdefault(pattern[:block], []).append(pattern)

    def search(self, words):
        """(start, pattern) of every occurrence, in order of start."""
        length, block, farthest = self.length, self.block, self.farthest
        shift, buckets = self.shift, self.buckets
        end, last = length, len(words)
        while end <= last:
            suffix = tuple(words[end - block : end])
            jump = shift.get(suffix, farthest)
            if jump:
                end += jump
                continue
            start = end - length
            tests = buckets[suffix].get(tuple(words[start : start + block]))
            if tests:
                candidate = tuple(words[start:end])
                for pattern in tests:
                    if pattern == candidate:
                        yield start, pattern
                        break
            end += 1


class Matcher:
    """All windows of a set of (item id, text) rows, by their lengths."""

    def __init__(self, rows):
        self.items = {}
        for item, text in rows:
            name = "" if item is None else str(item)
            for window in windows_of(words_of(text)):
                self.items.setdefault(window, set()).add(name)
        lengths = {}
        for window in self.items:
            lengths.setdefault(len(window), []).append(window)
        self.tables = [WuManber(group, length) for length, group in sorted(lengths.items())]

    def find(self, words):
        """Merged [start, end) runs of hit words and the names of the items found."""
        spans, names = [], set()
        for table in self.tables:
            for start, window in table.search(words):
                spans.append([start, start + table.length])
                names |= self.items[window]
        return merged(spans), sorted(names)


def merged(spans):
    out = []
    for start, end in sorted(map(list, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


class _Pass:
    """The benchmark rows of one pass; each Python worker builds their matcher once."""

    built = {}

    def __init__(self, spark, rows):
        self.key, self.rows = uuid.uuid4().hex, spark.sparkContext.broadcast(rows)

    def matcher(self):
        if self.key not in _Pass.built:
            _Pass.built.clear()
            _Pass.built[self.key] = Matcher(self.rows.value)
        return _Pass.built[self.key]


def _list_windows(batches):
    """(item, window) of each item, once for each batch; a window's words are joined by spaces."""
    for batch in batches:
        found = set()
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            found |= {(item, b" ".join(w).decode("utf-8", "surrogatepass")) for w in windows_of(words_of(text))}
        columns = list(zip(*found)) or [[], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string())], names=["item", "window"]
        )


def _passes(benchmark, item_col, text_col):
    """(number, last) and distinct windows of each part of about WORDS_PER_PASS windows.

    Windows are dealt to passes by their hash, so neither copies of an item nor a very long one fill
    a pass. A window is an item text of its own to the matcher.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    windows = staged(items.mapInArrow(_list_windows, "item string, window string").distinct(), "windows")
    size = windows.agg(F.count(F.lit(1)), F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0)))).first()
    parts = max(1, -(-size[0] // WORDS_PER_PASS), -(-(size[1] or 0) // CHARS_PER_PASS))
    part = F.pmod(F.xxhash64("item", "window"), F.lit(parts))
    for k in range(parts):
        rows = [(r.item, r.window) for r in windows.where(part == k).collect()]
        yield k, k == parts - 1, _Pass(benchmark.sparkSession, rows)


def _find_all(one, every):
    def run(batches):
        matcher = one.matcher()
        for batch in batches:
            rows, sizes, covered, items = [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                spans, names = matcher.find(words)
                if every or spans:
                    rows.append(row)
                    sizes.append(len(words))
                    covered.append(spans)
                    items.append(names)
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column("doc_id"),
                    kept.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(covered, pa.list_(pa.list_(pa.int32()))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "text_key", "n_words", "covered", "items"],
            )

    return run


def _merge_runs(batches):
    """Runs of the first pass with those of the later ones."""
    for batch in batches:
        kept = batch.drop_columns(["covered", "more_covered"])
        both = zip(batch.column("covered").to_pylist(), batch.column("more_covered").to_pylist())
        spans = [merged(a + (b or [])) for a, b in both]
        yield kept.append_column("covered", pa.array(spans, pa.list_(pa.list_(pa.int32()))))


def search(documents, benchmark, id_col="doc_id", text_col="text", item_col="item_id"):
    """Per document: doc_id, n_words, covered ([start, end) runs of hit words), items.

    One pass needs no shuffle. A benchmark of several passes has the hits of the later
    ones joined to the documents by id and digest of the text.
    """
    docs = documents.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.sha2(F.col(text_col), 256).alias("text_key"),
    )
    schema = FOUND.format(id=docs.schema["doc_id"].dataType.simpleString())
    found, more = None, None
    for k, last, one in _passes(benchmark, item_col, "text"):
        hits = docs.mapInArrow(_find_all(one, k == 0), schema)
        hits = hits if k == 0 and last else staged(hits, "decontaminate")
        if k == 0:
            found = hits
        else:
            more = hits if more is None else more.unionByName(hits)
    if more is not None:
        more = more.groupBy(F.col("doc_id").alias("k1"), F.col("text_key").alias("k2")).agg(
            F.flatten(F.collect_set("covered")).alias("more_covered"),
            F.flatten(F.collect_set("items")).alias("more_items"),
        )
        same = F.col("doc_id").eqNullSafe(F.col("k1")) & F.col("text_key").eqNullSafe(F.col("k2"))
        names = F.array_sort(F.array_union("items", F.coalesce("more_items", F.array())))
        found = (
            found.join(more, same, "left")
            .withColumn("items", names)
            .select("doc_id", "n_words", "items", "covered", "more_covered")
            .mapInArrow(
                _merge_runs,
                schema.replace("text_key string, ", "").replace(
                    "covered array<array<int>>, items array<string>",
                    "items array<string>, covered array<array<int>>",
                ),
            )
        )
    return found.select("doc_id", "n_words", "covered", "items")


def clean_documents(documents, benchmark, text_col="text", item_col="item_id"):
    """The rows of `documents` in which no window occurs, with all their columns."""

    def keep(one):
        def run(batches):
            matcher = one.matcher()
            for batch in batches:
                texts = batch.column(text_col).to_pylist()
                yield batch.filter(pa.array([not matcher.find(words_of(t))[0] for t in texts], pa.bool_()))

        return run

    kept = documents
    for k, _, one in _passes(benchmark, item_col, "text"):
        kept = staged(kept, "decontaminate") if k else kept
        kept = kept.mapInArrow(keep(one), documents.schema)
    return kept


def report(documents, benchmark):
    """The fixed columns per document; the digest is over the sorted, comma-joined item ids."""
    found = search(documents, benchmark)
    n_hit = F.aggregate("covered", F.lit(0).cast("long"), lambda a, s: a + (s[1] - s[0]))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
