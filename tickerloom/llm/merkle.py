"""Merkle tree fingerprints of texts: sections, paragraphs, leaves.

A paragraph is a line; its leaves are its clauses (cut after punctuation, and after LEAF_CHARS
characters where there is none). Blank lines end a section, and so does a paragraph whose
digest is a multiple of SECTION_PARAGRAPHS, so an edit moves only the sections it touches. A
node's digest is the hash of its children's digests; the root also covers the length.

The fingerprint is the tree as text: `root|section|section...`, a section being
`digest;paragraph;paragraph...` and a paragraph `digest,leaves`, with LEAF_SIZE characters per
leaf. Equal roots mean equal texts; comparing two trees descends only into branches whose
digests differ, which locates the edit, and gives the share of leaves in common.

Defined results: a null text is empty; an empty text has a tree without leaves, like only
another empty one. Documents are walked by descending id, null ids last, rows that share an id
by text; an empty table gives an empty result. The order of leaves counts in digests alone: texts whose
clauses are only reordered have other roots, but likeness 1. A very long text costs its leaves; rows that
share an id, null ids included, are walked in one task. Only the named columns are read.
"""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .text import utf8

LEAF_CHARS = 32
LEAF_SIZE = 4
SECTION_PARAGRAPHS = 8
RANGES_PER_PARTITION = 8

_LEAVES = re.compile(r"[^.,;:!?]{1,%d}[.,;:!?]*|[.,;:!?]+" % LEAF_CHARS)
# Leaf names are numbers in base 64.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_"
_PAIRS = [a + b for a in _DIGITS for b in _DIGITS]


def _leaves(paragraph):
    return [xxhash.xxh64_intdigest(utf8(leaf)) for leaf in _LEAVES.findall(paragraph)]


def _named(digest):
    return _PAIRS[digest & 4095] + _PAIRS[(digest >> 12) & 4095]


def _node(children):
    return xxhash.xxh64_intdigest(np.array(children, "<u8").tobytes())


class Tree:
    """Sections of (digest, [(digest, leaf names)]), and the root."""

    def __init__(self, text):
        text = text or ""
        self.sections, open_section = [], []
        for paragraph in text.split("\n"):
            leaves = _leaves(paragraph)
            digest = _node(leaves)
            open_section.append((digest, [_named(x) for x in leaves]))
            if not leaves or digest % SECTION_PARAGRAPHS == 0:
                self._close(open_section)
                open_section = []
        if open_section:
            self._close(open_section)
        parts = np.array([d for d, _ in self.sections], "<u8").tobytes()
        self.root = hashlib.blake2b(parts + b"%d" % len(text), digest_size=16).hexdigest()

    def _close(self, paragraphs):
        self.sections.append((_node([d for d, _ in paragraphs]), paragraphs))

    def __str__(self):
        parts = [self.root]
        for digest, paragraphs in self.sections:
            written = [f"{d & 0xFFFFFFFF:08x},{''.join(leaves)}" for d, leaves in paragraphs]
            parts.append(";".join([f"{digest & 0xFFFFFFFF:08x}", *written]))
        return "|".join(parts)


def parsed(fingerprint):
    """Root and sections [(digest, [(digest, leaf string)])] of a fingerprint."""
    root, *sections = fingerprint.split("|")
    out = []
    for section in sections:
        digest, *paragraphs = section.split(";")
        out.append((digest, [tuple(p.split(",")) for p in paragraphs]))
    return root, out


def _unmatched(ours, theirs):
    """Children of each side whose digests the other side lacks, as multisets."""
    mine, other = Counter(d for d, _ in ours), Counter(d for d, _ in theirs)
    spare_mine, spare_other = mine - other, other - mine

    def rest(children, spare):
        out = []
        for place, (digest, below) in enumerate(children):
            if spare[digest] > 0:
                spare[digest] -= 1
                out.append((place, digest, below))
        return out

    return rest(ours, spare_mine), rest(theirs, spare_other)


def differing(first, second):
    """(section, paragraph) places in the first and in the second tree where they differ."""
    (root_a, a), (root_b, b) = parsed(first), parsed(second)
    if root_a == root_b:
        return [], []
    left, right = _unmatched(a, b)
    flat_a = [((s, p), d, x) for s, _, section in left for p, (d, x) in enumerate(section)]
    flat_b = [((s, p), d, x) for s, _, section in right for p, (d, x) in enumerate(section)]
    only_a, only_b = _unmatched([x[1:] for x in flat_a], [x[1:] for x in flat_b])
    return [flat_a[i][0] for i, _, _ in only_a], [flat_b[i][0] for i, _, _ in only_b]


def _leaf_names(paragraph):
    return [paragraph[i : i + LEAF_SIZE] for i in range(0, len(paragraph), LEAF_SIZE)]


def likeness(first, second):
    """Share of leaves in common (twice the common ones over all), from the fingerprints alone."""
    if first == second:
        return 1.0
    (root_a, a), (root_b, b) = parsed(first), parsed(second)
    total = sum(len(x) for side in (a, b) for _, section in side for _, x in section) // LEAF_SIZE
    if root_a == root_b or not total:
        return float(root_a == root_b)
    left, right = _unmatched(a, b)
    paragraphs_a = [p for _, _, section in left for p in section]
    paragraphs_b = [p for _, _, section in right for p in section]
    only_a, only_b = _unmatched(paragraphs_a, paragraphs_b)
    lone_a = Counter(n for _, _, x in only_a for n in _leaf_names(x))
    lone_b = Counter(n for _, _, x in only_b for n in _leaf_names(x))
    differing_leaves = sum((lone_a - lone_b).values()) + sum((lone_b - lone_a).values())
    return 1.0 - differing_leaves / total


def fingerprint(text):
    return str(Tree(text))


def edited(text, following):
    """The last half of the text replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare_ranges(batches):
    """Rows sorted by range and descending id, each range ending with the next one's first row."""
    held = None
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("part", "extra", "doc_id", "text")]
        for part, extra, doc_id, text in zip(*columns):
            text = text or ""
            tree = fingerprint(text)
            if held is not None and held[0] == part:
                _, key, own, own_tree = held
                changed = edited(own, text)
                changed_tree = fingerprint(changed)
                out.append(
                    (
                        key, len(own), hashlib.sha256(utf8(changed)).hexdigest(), own_tree,
                        changed_tree, likeness(own_tree, changed_tree), likeness(own_tree, tree),
                    )
                )
            held = None if extra else (part, doc_id, text, tree)
        columns = list(zip(*out)) or [[]] * 7
        kinds = [batch.schema.field("doc_id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=COLUMNS)


COLUMNS = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]


def compare_with_next(documents, ranges=None, id_col="doc_id", text_col="text"):
    """Fingerprints of each text, of its edited text and their likeness, in one shuffle of the texts.

    Ids are cut into ranges at their quantiles. Each range also gets the first row of the range
    after it (the last one that of the first), so every row meets its successor in its own task.
    Ids must be integers.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or partitions * RANGES_PER_PARTITION
    docs = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    # Descending ids are ascending ranks; a null id comes last.
    docs = docs.withColumn("rank", F.bitwise_not("doc_id"))
    steps = F.array(*[F.lit(k / ranges) for k in range(1, ranges)])
    cuts = docs.agg(F.percentile_approx("rank", steps, 100 * ranges)).first()[0]
    cuts = F.lit(sorted(set(cuts or []))).cast("array<bigint>")
    below = F.size(F.filter(cuts, lambda c: c < F.col("rank")))
    docs = docs.withColumn("part", F.when(F.col("rank").isNull(), F.size(cuts) + 1).otherwise(below))
    firsts = [
        (r["part"], r["rank"])
        for r in docs.groupBy("part").agg(F.min("rank").alias("rank")).orderBy("part").collect()
    ]
    previous = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}
    after_nulls = F.lit(previous.pop(None, None)).cast("int")
    to = F.create_map(*[F.lit(x).cast(t) for f, p in previous.items() for x, t in ((f, "bigint"), (p, "int"))])
    carried = F.when(F.col("rank").isNull(), after_nulls)
    if previous:
        carried = carried.otherwise(F.element_at(to, F.col("rank")))
    copies = F.filter(
        F.array(
            F.struct(F.col("part"), F.lit(False).alias("extra")),
            F.struct(carried.alias("part"), F.lit(True).alias("extra")),
        ),
        lambda c: c["part"].isNotNull(),
    )
    rows = docs.select("doc_id", "rank", "text", F.explode(copies).alias("copy")).select(
        "copy.part", "copy.extra", "doc_id", "rank", "text"
    )
    kinds = f"{COLUMNS[0]} long, n_chars long, " + ", ".join(f"{c} string" for c in COLUMNS[2:5])
    return (
        rows.repartition(partitions, "part")
        .sortWithinPartitions("part", "extra", "rank", "text")
        .select("part", "extra", "doc_id", "text")
        .mapInArrow(_compare_ranges, kinds + ", near_edited double, near_next double")
    )


def report(documents):
    return compare_with_next(documents)
