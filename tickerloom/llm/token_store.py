"""Binary token shards with a minimal perfect hash index over document keys.

A shard holds documents in ascending id order: the raw ids (little-endian, two bytes where the
vocabulary allows, else four), then the index, then a fixed footer. The index is a minimal
perfect hash: every level is a bit array that keeps keys which fall alone on a bit; the others
try the next level. The rank of a key's bit is its slot, which stores a 32-bit fingerprint
(foreign keys are refused), the number of its first record and how many records it has; the
record table gives payload offsets. A lookup reads a few words and one run of ids.

Files are written by the tasks through `pyarrow.fs` into the shared folder. Each attempt has a
file of its own, and only the files named in the manifest, which is written by successful tasks,
count; so a lost executor leaves at most files that nothing names.

Defined results: a null or empty text has only the end id; documents without an id come first,
are not in the index and are read by position; rows that share an id are consecutive records, one slot
of each shard they span, ordered by the first HEAD_CHARS characters of their texts; ids must be
integers. A very long text is encoded part by part.
"""

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.stages import new_folder, staged
from .tokens import END_ID, encoder

MAGIC = b"TLTOKEN1"
# index offset, id width, records, records without id, ids, slots, levels
FOOTER = struct.Struct("<QQQQQQQ8s")
# Bits per key and level; more levels than needed would cost only empty arrays.
GAMMA = 2
READ_RECORDS = 4096
HEAD_CHARS = 32


def mixed(keys, seed):
    """64-bit mix of integer keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(keys):
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n distinct integer keys."""

    def __init__(self, levels):
        self.levels = levels
        self.before, total = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.concatenate([[0], np.cumsum(ones)[:-1]]))
            total += int(ones.sum())
        self.size = total

    @classmethod
    def build(cls, keys):
        levels, left = [], np.asarray(keys, np.int64)
        while len(left):
            words = -(-GAMMA * len(left) // 64)
            bits = (mixed(left, len(levels)) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(bits, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[bits]]
        return cls(levels)

    def slots(self, keys):
        """Slot of each key; a key that was not built in gets any slot or -1."""
        keys = np.asarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            if not len(rest):
                break
            bits = (mixed(keys[rest], level) % np.uint64(len(words) * 64)).astype(np.int64)
            at, bit = bits >> 6, (bits & 63).astype(np.uint64)
            word = words[at]
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[rest[here]] = (before[at] + below)[here]
            rest = rest[~here]
        return out


def _packed(arrays):
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


class ShardWriter:
    """Writes ids as they come; the index needs a few numbers per document."""

    def __init__(self, sink, width):
        self.sink, self.width, self.ids = sink, width, 0
        self.keys, self.ends, self.nameless = [], [], 0

    def add(self, key, ids):
        """`ids` as little-endian unsigned 32-bit bytes; keys ascend, documents without one first."""
        if key is None:
            self.nameless += 1
        else:
            self.keys.append(key)
        self.sink.write(ids if self.width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())
        self.ids += len(ids) // 4
        self.ends.append(self.ids)

    def finish(self):
        keys, first, records = np.unique(
            np.array(self.keys, "<i8"), return_index=True, return_counts=True
        )
        index = PerfectHash.build(keys)
        order = np.argsort(index.slots(keys))
        slots = [
            fingerprints(keys)[order].astype("<u4"),
            (first[order] + self.nameless).astype("<u8"),
            records[order].astype("<u8"),
            keys[order].astype("<i8"),
        ]
        offsets = np.array([0, *self.ends], "<u8")
        sizes = np.array([len(words) for words in index.levels], "<u8")
        self.sink.write(_packed([offsets, *slots, sizes, *index.levels]))
        at = self.ids * self.width
        self.sink.write(
            FOOTER.pack(at, self.width, len(self.ends), self.nameless, self.ids, len(keys), len(sizes), MAGIC)
        )


class ShardReader:
    """Keyed and positional access to one shard."""

    def __init__(self, path):
        system, name = pyarrow.fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(FOOTER.size, size - FOOTER.size)
        at, self.width, self.records, self.nameless, self.ids, self.keys, levels, magic = FOOTER.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        raw = self.file.read_at(size - FOOTER.size - at, at)
        self._at = 0

        def take(kind, n):
            out = np.frombuffer(raw, kind, n, self._at)
            self._at += out.nbytes
            return out

        self.offsets = take("<u8", self.records + 1).astype(np.int64)
        self.fingerprints = take("<u4", self.keys)
        self.first = take("<u8", self.keys).astype(np.int64)
        self.count = take("<u8", self.keys).astype(np.int64)
        self.slot_keys = take("<i8", self.keys)
        sizes = take("<u8", levels)
        self.index = PerfectHash([take("<u8", int(n)) for n in sizes])

    def close(self):
        self.file.close()

    def find(self, keys):
        """First record and number of records of each key; (-1, 0) for a key not in the shard."""
        keys = np.asarray(keys, np.int64)
        slots = self.index.slots(keys)
        known = slots >= 0
        known[known] = self.fingerprints[slots[known]] == fingerprints(keys[known])
        first, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        first[known], count[known] = self.first[slots[known]], self.count[slots[known]]
        return first, count

    def read(self, start, end):
        """Ids of records [start, end) as unsigned 32-bit, and their lengths."""
        lo, hi = int(self.offsets[start]), int(self.offsets[end])
        raw = self.file.read_at((hi - lo) * self.width, lo * self.width)
        ids = np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")
        return ids, np.diff(self.offsets[start : end + 1])

    def get(self, key):
        """Id arrays of the documents with this key."""
        (first,), (count,) = self.find([key])
        if not count:
            return []
        ids, sizes = self.read(first, first + count)
        return np.split(ids, np.cumsum(sizes)[:-1])

    def all_keys(self):
        """The key of every record, by way of the index; None for those without one."""
        keys = np.sort(self.slot_keys)
        first, count = self.find(keys)
        order = np.argsort(first)
        named = np.repeat(keys[order], count[order])
        return [None] * self.nameless + named.tolist()


MANIFEST = "shard int, path string, n_docs long, n_ids long, first_id long, last_id long"


def _write(folder, tokenizer):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        coder = encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        system, name = pyarrow.fs.FileSystem.from_uri(path)
        sink = writer = None
        for batch in batches:
            if writer is None and len(batch):
                system.create_dir(name.rpartition("/")[0], recursive=True)
                sink = system.open_output_stream(name)
                writer = ShardWriter(sink, 2 if coder.vocabulary <= 1 << 16 else 4)
            texts = coder.encode_all(batch.column("text").to_pylist())
            for key, ids in zip(batch.column("doc_id").to_pylist(), texts):
                writer.add(key, ids + end)
        if writer is not None:
            writer.finish()
            sink.close()
            ids = writer.keys or [None]
            row = [[shard], [path], [len(writer.ends)], [writer.ids], [ids[0]], [ids[-1]]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)],
                names=["shard", "path", "n_docs", "n_ids", "first_id", "last_id"],
            )

    return run


def write(documents, tokenizer, shards=None, id_col="doc_id", text_col="text"):
    """Write the shards; returns their manifest with the number of ids before each (`start`)."""
    spark = documents.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, "tokens")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Rows that share an id are cut into ranges too: by the start of their text, then at random.
    cut = docs.withColumns({"head": F.left("text", F.lit(HEAD_CHARS)), "salt": F.rand(0)})
    ranges = cut.repartitionByRange(shards, "doc_id", "head", "salt")
    in_order = ranges.select("doc_id", "text").sortWithinPartitions("doc_id", "text")
    manifest = staged(in_order.mapInArrow(_write(folder, tokenizer), MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches):
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            shard = ShardReader(path)
            keys = shard.all_keys()
            for at in range(0, shard.records, READ_RECORDS):
                to = min(at + READ_RECORDS, shard.records)
                ids, sizes = shard.read(at, to)
                raw, edges = memoryview(ids.tobytes()), np.concatenate([[0], np.cumsum(sizes)]) * 4
                crc = [zlib.crc32(raw[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at:to], pa.int64()),
                        pa.array(start + shard.offsets[at:to]),
                        pa.array(sizes),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
            shard.close()


def read(manifest):
    """doc_id, start, n_tokens, ids_crc32 of every record, read back from the files."""
    shards = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        manifest.select("shard", "path", "start")
        .repartitionByRange(shards, "shard")
        .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def report(documents, tokenizer):
    """Write, then read back."""
    return read(write(documents, tokenizer))
