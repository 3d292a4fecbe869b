"""Best-fit packing of tokenized documents into sequences by large-item matching.

How pieces share sequences depends on their lengths alone, so the plan is made from the
number of pieces of each length (at most `capacity` numbers, whatever the input). Pieces above
a third of the capacity fit at most twice into a sequence: the longest is matched with the
longest that still fits beside it. Shorter ones, longest first, fill the tightest gap that
takes them, and open a sequence where there is none. The plan gives runs of equal pieces to
runs of sequences; every piece finds its place from its rank among pieces of its length. Ranks
are counted per length and salt, so a length that a third of all pieces share is split.

Defined results: a null or empty text is a piece of the end id alone; null ids stay null;
repeated rows are packed once each; an empty table gives an empty result. A very long text is encoded
part by part and cut into pieces. Only the named columns are read.
"""

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.stages import staged
from .tokens import END_ID, encoder

CAPACITY = 4096
# Parts in which the pieces of one length are ranked: at least so many, and of about so many pieces.
SALTS = 256
RANKED_ROWS = 1_000_000
# Texts of a batch that are taken together.
TEXTS = 256


def _texts(column):
    """The texts of a batch, of which few are Python strings at a time."""
    for at in range(0, len(column), TEXTS):
        yield from column.slice(at, TEXTS).to_pylist()


def _cut(path, capacity):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        encode_all = encoder(path).encode_all
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encode_all(_texts(batch.column("text")))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(documents, path, capacity=CAPACITY, id_col="doc_id", text_col="text"):
    """doc_id, piece, start, length, ids_crc32: only documents over the capacity are cut."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        _cut(path, capacity),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
    )


class _Plan:
    """Runs (first rank, first sequence, pieces per sequence, offset) of each length."""

    def __init__(self, counts, capacity):
        self.capacity = capacity
        self.left = dict(counts)
        self.used = dict.fromkeys(counts, 0)
        self.runs = {length: [] for length in counts}
        self.sequences = 0
        self.gaps = []
        self.open = {}
        self._match_large()
        self._fit_small()

    def _place(self, length, sequence, sequences, each, offset):
        """Put `each` pieces of one length at `offset` of each of `sequences` sequences."""
        self.runs[length].append((self.used[length], sequence, each, offset))
        self.used[length] += sequences * each
        self.left[length] -= sequences * each

    def _new(self, sequences):
        first = self.sequences
        self.sequences += sequences
        return first

    def _keep(self, gap, first, sequences):
        if gap and sequences:
            if gap not in self.open:
                self.open[gap] = []
                insort(self.gaps, gap)
            self.open[gap].append((first, sequences))

    def _match_large(self):
        large = sorted(length for length in self.left if 3 * length > self.capacity)
        while large:
            length = large[-1]
            n = self.left[length]
            if not n:
                large.pop()
                continue
            most = min(length if n > 1 else length - 1, self.capacity - length)
            at = bisect_left(large, most + 1) - 1
            while at >= 0 and not self.left[large[at]]:
                at -= 1
            if at < 0:
                first = self._new(n)
                self._place(length, first, n, 1, 0)
                self._keep(self.capacity - length, first, n)
            elif large[at] == length:
                first = self._new(n // 2)
                self._place(length, first, n // 2, 2, 0)
                self._keep(self.capacity - 2 * length, first, n // 2)
            else:
                mate = large[at]
                pairs = min(n, self.left[mate])
                first = self._new(pairs)
                self._place(length, first, pairs, 1, 0)
                self._place(mate, first, pairs, 1, length)
                self._keep(self.capacity - length - mate, first, pairs)

    def _fit_small(self):
        for length in sorted((x for x in self.left if 3 * x <= self.capacity), reverse=True):
            while self.left[length]:
                at = bisect_left(self.gaps, length)
                if at < len(self.gaps):
                    gap = self.gaps[at]
                    first, sequences = self.open[gap].pop()
                    if not self.open[gap]:
                        del self.open[gap]
                        self.gaps.pop(at)
                else:
                    gap = self.capacity
                    sequences = -(-self.left[length] // (gap // length))
                    first = self._new(sequences)
                each = min(gap // length, self.left[length])
                full = min(sequences, self.left[length] // each)
                self._place(length, first, full, each, self.capacity - gap)
                self._keep(gap - each * length, first, full)
                if gap < self.capacity:
                    self._keep(gap, first + full, sequences - full)
                elif full < sequences:
                    rest = self.left[length]
                    self._place(length, first + full, 1, rest, 0)
                    self._keep(gap - rest * length, first + full, 1)

    def arrays(self):
        return {length: np.array(runs, np.int64).T.copy() for length, runs in self.runs.items() if runs}


def plan(counts, capacity=CAPACITY):
    """{length: 4 x runs array} that places `counts[length]` pieces of every length."""
    return _Plan({int(k): int(v) for k, v in counts.items()}, capacity).arrays()


def _seat(places):
    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence = np.empty(len(length), np.int64)
            offset = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, edges):
                if not len(rows):
                    continue
                size = int(length[rows[0]])
                ranks, firsts, each, start = places.value[size]
                run_no = np.searchsorted(ranks, rank[rows], side="right") - 1
                inside = rank[rows] - ranks[run_no]
                sequence[rows] = firsts[run_no] + inside // each[run_no]
                offset[rows] = start[run_no] + inside % each[run_no] * size
            yield (
                batch.drop_columns(["rank"])
                .append_column("sequence_id", pa.array(sequence))
                .append_column("offset", pa.array(offset))
            )

    return run


def seats(cut, capacity=CAPACITY):
    """`cut` (staged pieces) with sequence_id and offset."""
    spark = cut.sparkSession
    sizes = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = spark.sparkContext.broadcast(plan(sizes, capacity))
    salts = max(SALTS, -(-max(sizes.values(), default=0) // RANKED_ROWS))
    at = F.struct("_metadata.file_path", "_metadata.row_index")
    salted = cut.select("*", at.alias("at")).withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    )
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("at")) - 1
    ranked = (
        salted.withColumn("own", own)
        .join(earlier, ["length", "salt"])
        .select(*cut.columns, (F.col("own") + F.col("earlier")).alias("rank"))
    )
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_seat(places), schema)


def pack(documents, path, capacity=CAPACITY, id_col="doc_id", text_col="text"):
    """Every piece with its sequence and place there."""
    return seats(staged(pieces(documents, path, capacity, id_col, text_col), "pieces"), capacity)
