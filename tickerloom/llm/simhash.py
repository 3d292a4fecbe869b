"""SimHash near-duplicates by bit-sliced comparison.

Distinct fingerprints are dealt into buckets that agree on some of their bits: with 64
bits in BANDS bands and a radius of r, two fingerprints within r agree on at least
BANDS - r whole bands, so every choice of that many bands gets a table. Within a bucket the
fingerprints lie vertically: plane b holds bit b of all of them. A query is compared with
all at once, four planes at a time, by carry-save adders into bitwise counters; a block is
abandoned as soon as every counter exceeds the radius. A bucket of any size is cut into
tiles, and each tile returns a spanning forest instead of all its pairs. Components come
from alternating large-star and small-star steps over the links.

Defined results: a null or empty text has fingerprint 0, linked like any other; a null id
takes part in links but never names a component that has another id; repeated rows give
repeated rows; an empty table gives an empty result. A very long text costs the hashes of its shingles.
Only the named columns are read, so other columns cannot clash.
"""

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import checked_broadcast
from ..sources.stages import staged
from .text import UPPER_TO_LOWER, utf8

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BANDS = 6
# Fingerprints of a bucket that one task compares with as many others.
TILE = 4096
QUERIES_AT_ONCE = 128
# Buckets up to this size are compared by their pairs, many buckets at once.
SMALL_BUCKET = 24
ROWS_AT_ONCE = 1 << 16

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text, shingle_words=SHINGLE_WORDS):
    """Unsigned 64-bit SimHash over word shingles, repeats included."""
    words = utf8(text).translate(UPPER_TO_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle_words:
        return digest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hashes = np.array(
        [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle_words - 1 :])],
        dtype="<u8",
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        out = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fp"]
        )


def fingerprints(documents, id_col="doc_id", text_col="text"):
    """(doc_id, fp): the 64 bits as a signed long."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_fingerprints, f"doc_id {kind}, fp long")


def _planes(values):
    """64 rows of bits, each bit of a row belonging to one value; padded to whole words."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    wide = np.zeros((64, -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view("<u8")


def _add(a, b, c):
    """Carry-save adder: sum and carry of three bits in every lane."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _within(plane_of, shape, radius):
    """Lanes whose number of set planes is at most `radius` (below 8), as packed words."""
    ones, twos, fours, over = (np.zeros(shape, np.uint64) for _ in range(4))
    beyond = over
    for b in range(0, 64, 4):
        ones, carry_a = _add(ones, plane_of(b), plane_of(b + 1))
        ones, carry_b = _add(ones, plane_of(b + 2), plane_of(b + 3))
        twos, carry = _add(twos, carry_a, carry_b)
        over = over | (fours & carry)
        fours = fours ^ carry
        beyond = over.copy()
        for count in range(radius + 1, 8):
            beyond |= (
                (fours if count & 4 else ~fours)
                & (twos if count & 2 else ~twos)
                & (ones if count & 1 else ~ones)
            )
        if (beyond == ALL).all():
            break
    return ~beyond


def _pairs_within(left, right, radius):
    """Which of the pairs (left[i], right[i]) are within the radius."""
    planes = _planes(left ^ right)
    near = _within(lambda b: planes[b], planes.shape[1], radius)
    return np.unpackbits(near.view(np.uint8), bitorder="little")[: len(left)].astype(bool)


def _forest(queries, values, radius):
    """Spanning links among values, or between queries and values, within the radius."""
    planes, n = _planes(values), len(values)
    same = queries is values
    labels = np.arange(n + (0 if same else len(queries)))
    links = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        chosen = queries[at : at + QUERIES_AT_ONCE].astype(np.uint64)
        flips = [(ALL * ((chosen >> np.uint64(b)) & np.uint64(1)))[:, None] for b in range(64)]
        near = _within(lambda b: planes[b] ^ flips[b], (len(chosen), planes.shape[1]), radius)
        for q in np.flatnonzero(near.any(axis=1)):
            hits = np.flatnonzero(np.unpackbits(near[q].view(np.uint8), bitorder="little")[:n])
            me = at + q + (0 if same else n)
            roots, first = np.unique(labels[hits], return_index=True)
            new = roots != labels[me]
            if new.any():
                links += [(chosen[q], values[hits[i]]) for i in first[new]]
                merged = np.append(roots, labels[me])
                labels[np.isin(labels, merged)] = merged.min()
    return links


def _bucket_links(fps, sides, radius):
    """Links of one tile: within one chunk, or between the chunks of sides 0 and 1."""
    if sides.any() and not sides.all():
        return _forest(fps[sides == 1], fps[sides == 0], radius)
    return _forest(fps, fps, radius)


def _links(radius):
    """Links from rows sorted by bucket and tile."""

    def compare(table):
        names = ("table", "bits", "tile")
        keys = [table[c].to_numpy() for c in names]
        fps, sides = table["fp"].to_numpy().view(np.uint64), table["side"].to_numpy()
        new = np.ones(len(fps), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fps)))
        group = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= SMALL_BUCKET, sizes)
        links = []
        for gap in range(1, SMALL_BUCKET):
            at = np.flatnonzero((group[gap:] == group[:-gap]) & small[gap:])
            if not len(at):
                break
            near = at[_pairs_within(fps[at], fps[at + gap], radius)]
            links.append(np.stack([fps[near], fps[near + gap]], axis=1))
        for start, size in zip(starts, sizes):
            if size > SMALL_BUCKET:
                rows = slice(start, start + size)
                found = _bucket_links(fps[rows], sides[rows], radius)
                if found:
                    links.append(np.array(found, dtype=np.uint64))
        return np.concatenate(links) if links else np.zeros((0, 2), np.uint64)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < ROWS_AT_ONCE:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cut = _last_start(table)
            if cut:
                yield _as_batch(compare(table.slice(0, cut)))
            held = table.slice(cut).to_batches()
            rows = len(table) - cut
        if rows:
            yield _as_batch(compare(pa.Table.from_batches(held).combine_chunks()))

    return run


def _last_start(table):
    """Row at which the last (unfinished) tile begins."""
    keys = [table[c].to_numpy() for c in ("table", "bits", "tile")]
    same = np.all([k == k[-1] for k in keys], axis=0)
    return int(len(same) - np.argmin(same[::-1])) if not same.all() else 0


def _as_batch(links):
    links = links.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"]
    )


def band_masks(radius=RADIUS, bands=BANDS):
    """Signed masks: each choice of bands that two fingerprints within the radius share."""
    edges = [64 * k // bands for k in range(bands + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, bands - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct, radius=RADIUS, tile=TILE):
    """Links (a, b) among distinct fingerprints that connect all those within the radius."""
    masks = F.array(*[F.lit(m).cast("long") for m in band_masks(radius)])
    dealt = distinct.select("fp", F.posexplode(masks).alias("table", "mask")).select(
        "fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("bits")
    )
    large = (
        dealt.groupBy("table", "bits")
        .count()
        .where(F.col("count") > tile)
        .select("table", "bits", F.ceil(F.col("count") / tile).cast("int").alias("chunks"))
    )
    one = F.lit(1).cast("int")
    dealt = dealt.join(large, ["table", "bits"], "left").withColumn("chunks", F.coalesce("chunks", one))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks").cast("long")).cast("int")
    dealt = dealt.withColumn("own", own).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    tiles = dealt.select(
        "table",
        "bits",
        (low.cast("long") * F.col("chunks") + high).alias("tile"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "fp",
    )
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        tiles.repartition(parts, "table", "bits", "tile")
        .sortWithinPartitions("table", "bits", "tile")
        .mapInArrow(_links(radius), "a long, b long")
    )


def components(edges):
    """(node, label) for every node of the links; the label is the least node reached.

    Alternates large-star (each node links its larger neighbours to its least one) and
    small-star (each node links itself and its smaller neighbours to the least of them)
    until the links no longer change; the links are staged after every round.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = staged(pairs.where("u > v").distinct(), "components")
    state = None
    while True:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        )
        now = staged(small.where("u > v").distinct(), "components")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        roots.select("node", F.col("node").alias("label"))
    )


def cluster(documents, radius=RADIUS, id_col="doc_id", text_col="text"):
    """(doc_id, fp, component_id): the smallest id that links reach from each document."""
    fps = staged(fingerprints(documents, id_col, text_col), "simhash")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash")
    edges = staged(links(distinct.select("fp"), radius), "simhash")
    labels = components(edges).withColumnRenamed("node", "fp")
    labelled = distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    named = labelled.select("fp", "label").join(least, "label").select("fp", "component_id", "label")
    return fps.join(named, "fp")


def representatives(documents, radius=RADIUS, id_col="doc_id", text_col="text"):
    """One row of each component, with all its columns: the one with the smallest id.

    Of rows that share that id, and of components without any id, one row stays.
    """
    groups = staged(cluster(documents, radius, id_col, text_col), "simhash")
    ids = groups.where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct()
    named = documents.join(ids, id_col, "left_semi").dropDuplicates([id_col])
    lone = groups.where("component_id is null").select("fp", "label").distinct()
    if lone.isEmpty():
        return named
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    nameless = documents.where(F.col(id_col).isNull()).select(whole, F.col(text_col).alias("text"))
    schema = T.StructType([nameless.schema["row"], T.StructField("fp", T.LongType())])
    kept = nameless.mapInArrow(_with_fingerprint, schema).join(lone, "fp").dropDuplicates(["label"])
    return named.unionByName(kept.select("row.*"))


def group_representatives(documents, radius=RADIUS, id_col="doc_id", text_col="text"):
    """One row of each group of linked rows, with all its columns: that with the least (id, text).

    Null ids come last. Rows that share an id but not a group are told apart by their fingerprints.
    """
    groups = staged(cluster(documents, radius, id_col, text_col), "simhash")
    shared = groups.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("shared"))
    wanted = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    wanted = wanted.select("doc_id", "fp", "label").distinct().join(checked_broadcast(shared), "doc_id", "left")
    wanted = staged(wanted.withColumn("shared", F.col("doc_id").isNull() | F.col("shared").isNotNull()), "simhash")
    ids = wanted.where("not shared").select(F.col("doc_id").alias(id_col))
    named = documents.join(ids, id_col, "left_semi")
    rest = wanted.where("shared")
    if rest.isEmpty():
        return named
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(whole, F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())])
    rows = rows.mapInArrow(_with_fingerprint, schema).withColumn("id", F.col("row").getField(id_col))
    rest = checked_broadcast(rest.select(F.col("doc_id").alias("own"), F.col("fp").alias("mark"), "label"))
    found = rows.join(rest, (F.col("fp") == F.col("mark")) & F.col("id").eqNullSafe(F.col("own")))
    kept = found.groupBy("label").agg(F.min_by("row", F.struct(F.col("row").getField(text_col))).alias("row"))
    return named.unionByName(kept.select("row.*"))


def _with_fingerprint(batches):
    for batch in batches:
        out = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(out.view(np.int64))], names=["row", "fp"]
        )


def report(documents):
    """doc_id, the fingerprint as 16 hex digits, component_id."""
    return cluster(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
