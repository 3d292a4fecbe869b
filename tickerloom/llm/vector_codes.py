"""Product quantisation of vectors in whole numbers, searched in the Walsh-Hadamard domain.

A component x becomes floor(1024 * x); a vector is cut into four parts, each with a codebook of
its own. Parts and entries are padded with zeros to a power of two and transformed by an integer
Walsh-Hadamard transform in sequency order. The transform keeps distances up to a factor, the
padded length, so squared differences of coefficients add up to an exact scaled distance. The first
few coefficients, which hold most of it, are compared for all entries; the entry that is then
nearest gives a bound, and entries beyond it are dropped as further coefficients come in.

Rounds. A task adds up the parts of each entry over all its rows and sends on one sum for each
entry and position, so what is shuffled and what reaches the driver depends on the size of the
codebooks alone. Sums are cut into limbs of 40 bits and never wrap. Every round reads one written
stage; the codebooks travel as a broadcast of the same bounded size.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped.
Shorter vectors are lengthened with zeros to the longest one, and that to a multiple of the number
of parts, which changes no distance. The first entries are the rows of the smallest ids, missing
ids last, rows that share an id by their vectors; with fewer rows than entries a codebook is
shorter. Rows are coded one by one, so repeated rows stay. Components of any finite size are exact:
beyond what 64-bit sums can hold, Python's integers are used; an error beyond 64 bits is null, and
so is the sum of a label that holds one. An empty table gives an empty result. Only the named
columns are read.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..sources.stages import staged

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Coefficients compared for all entries, and then at a time.
HEAD = 4
STEP = 4
# Rows searched at once.
TILE = 2048
LIMB_BITS = 40
# Labels with more than this share of all rows are joined by broadcast: no more than its inverse.
HOT_SHARE = 1 / 10_000
COUNT = -1
LONGS = 1 << 63


def _power(n):
    """The least power of two that is at least n."""
    return 1 << max(n - 1, 0).bit_length()


def sequency_order(n):
    """Positions of a transform of length n by rising number of sign changes."""
    bits = n.bit_length() - 1
    order = []
    for s in range(n):
        gray = s ^ (s >> 1)
        order.append(int(f"{gray:0{bits}b}"[::-1], 2) if bits else 0)
    return order


def transformed(rows):
    """Walsh-Hadamard transform of zero-padded integer rows, in sequency order."""
    n, length = rows.shape
    size = _power(length)
    out = np.zeros((n, size), rows.dtype)
    out[:, :length] = rows
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        low, high = pairs[:, :, 0, :].copy(), pairs[:, :, 1, :].copy()
        pairs[:, :, 0, :], pairs[:, :, 1, :] = low + high, low - high
        half *= 2
    return out[:, sequency_order(size)]


def _squares(differences):
    return (differences * differences).sum(axis=-1)


def _search(values, entries):
    """Index of the nearest entry (the lower of equals) and scaled distance, in 64 bits."""
    n, size = values.shape
    head = min(HEAD, size)
    sums = np.zeros((n, len(entries)), np.int64)
    for s in range(head):
        difference = values[:, s, None] - entries[None, :, s]
        sums += difference * difference
    bound = _squares(values - entries[sums.argmin(axis=1)])
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for at in range(head, size, STEP):
        here = slice(at, at + STEP)
        sums = sums + _squares(values[row, here] - entries[entry, here])
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    order = np.lexsort((entry, sums, row))
    first = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])] if n else order
    return entry[first], sums[first]


def _search_wide(values, entries):
    """The same in Python's integers, row by row."""
    found = []
    for row in values.tolist():
        best, index = None, 0
        for k, entry in enumerate(entries.tolist()):
            total = 0
            for a, b in zip(row, entry):
                total += (a - b) * (a - b)
                if best is not None and total >= best:
                    break
            else:
                best, index = total, k
        found.append((index, best))
    index, distance = zip(*found) if found else ((), ())
    return np.array(index, np.int64), np.array(distance, object)


def _largest(rows):
    return max((abs(int(rows.min())), abs(int(rows.max())))) if rows.size else 0


def nearest(rows, entries):
    """Index of and squared distance to the nearest entry for each row; exact for any size."""
    size = _power(rows.shape[1])
    if not rows.shape[1]:
        return np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if 4 * size * size * max(_largest(rows), _largest(entries), 1) ** 2 >= LONGS:
        index, distance = _search_wide(transformed(rows.astype(object)), transformed(entries.astype(object)))
        return index, distance // size if len(distance) else distance
    changed = transformed(entries.astype(np.int64))
    index, distance = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for at in range(0, len(rows), TILE):
        here = slice(at, at + TILE)
        index[here], distance[here] = _search(transformed(rows[here].astype(np.int64)), changed)
    return index, distance // size


def whole_numbers(vectors, dims):
    """floor(SCALE * x) of an Arrow list column, as rows of `dims` numbers."""
    values = vectors.flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    if np.abs(values).max(initial=0) < 2.0**50:
        numbers = np.floor(values * SCALE).astype(np.int64)
    else:
        numbers = [math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE for x in values.tolist()]
        numbers = np.array(numbers, object)
    out = np.zeros((len(vectors), dims), numbers.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = numbers
    return out


def _cut(rows, parts):
    """The columns of each part."""
    length = rows.shape[1] // parts
    return [rows[:, p * length : (p + 1) * length] for p in range(parts)]


def _limbs(number):
    """Limbs from the lowest on; the last one has the sign."""
    while not -(1 << LIMB_BITS) < number < 1 << LIMB_BITS:
        yield number & ((1 << LIMB_BITS) - 1)
        number >>= LIMB_BITS
    yield number


def _add_up(codebooks, dims):
    """Sums and counts of the parts of every entry, over all rows of a task."""

    def run(batches):
        books = codebooks.value
        sums = [np.zeros(book.shape, object) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            rows = whole_numbers(batch.column("vector"), dims)
            if _largest(rows) * len(rows) >= LONGS:
                rows = rows.astype(object)
            for p, part in enumerate(_cut(rows, len(books))):
                index, _ = nearest(part, books[p])
                order = np.argsort(index, kind="stable")
                found, first = np.unique(index[order], return_index=True)
                if len(found):
                    sums[p][found] += np.add.reduceat(part[order], first, axis=0).astype(object)
                counts[p] += np.bincount(index, minlength=len(books[p]))
        rows = []
        for p, book in enumerate(books):
            for entry in np.flatnonzero(counts[p]).tolist():
                rows.append((p, entry, COUNT, 0, int(counts[p][entry])))
                for position, total in enumerate(sums[p][entry].tolist()):
                    rows += [(p, entry, position, k, limb) for k, limb in enumerate(_limbs(total)) if limb]
        columns = zip(*rows) if rows else [[]] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["part", "entry", "position", "limb", "value"],
        )

    return run


def _moved(books, sums):
    """Every used entry at the floored mean of its parts."""
    totals, counts = {}, {}
    for part, entry, position, limb, value in sums:
        if position == COUNT:
            counts[part, entry] = value
        else:
            at = (part, entry, position)
            totals[at] = totals.get(at, 0) + (value << (LIMB_BITS * limb))
    out = []
    for p, book in enumerate(books):
        rows = [
            [totals.get((p, e, j), 0) // counts[p, e] for j in range(len(row))] if (p, e) in counts else row
            for e, row in enumerate(book.tolist())
        ]
        out.append(_numbers(rows, book.shape))
    return out


def _numbers(rows, shape):
    try:
        return np.array(rows, np.int64).reshape(shape)
    except OverflowError:
        return np.array(rows, object).reshape(shape)


def kept(table, id_col="vec_id", vector_col="embedding", label_col="label"):
    """vec_id, label, vector of the rows whose vector has only finite components, as a stage."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    rows = table.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    return staged(rows.where(F.col("vector").isNotNull() & finite), "vectors")


class Codebooks:
    """One array of entries for each part; vectors have `dims` components once lengthened."""

    def __init__(self, books, dims):
        self.books, self.dims = books, dims

    def digest(self):
        numbers = [str(x) for book in self.books for x in book.reshape(-1).tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def fit(rows, parts=PARTS, entries=ENTRIES, rounds=ROUNDS):
    """Codebooks after `rounds` rounds over all `rows` (the result of `kept`)."""
    spark = rows.sparkSession
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    dims = -(-longest // parts) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries)
    start = whole_numbers(first.toArrow().column("vector").combine_chunks(), dims)
    books = [_numbers(part.tolist(), part.shape) for part in _cut(start, parts)]
    if not len(start):
        return Codebooks(books, dims)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        summed = (
            rows.select("vector")
            .mapInArrow(_add_up(shared, dims), "part int, entry int, position int, limb int, value long")
            .groupBy("part", "entry", "position", "limb")
            .agg(F.sum("value").alias("value"))
        )
        # One row for each entry, position and limb: bounded by the size of the codebooks.
        books = _moved(books, [tuple(r) for r in summed.collect()])
        shared.unpersist()
    return Codebooks(books, dims)


def _encode(codebooks, dims):
    def run(batches):
        for batch in batches:
            rows = whole_numbers(batch.column("vector"), dims)
            error = np.zeros(len(rows), object)
            codes = np.zeros((len(rows), len(codebooks.value)), np.int64)
            for p, part in enumerate(_cut(rows, len(codebooks.value))):
                codes[:, p], distance = nearest(part, codebooks.value[p])
                error += distance
            texts = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            errors = [e if e < LONGS else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def encode(rows, codebooks):
    """vec_id, label, code, error of all `rows` (the result of `kept`)."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks.books)
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        _encode(shared, codebooks.dims),
        f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long",
    )


def decode(codes, codebooks):
    """`codes` with the vector that each code stands for, as `decoded`."""
    tables = [
        F.array(*[F.lit([x / SCALE for x in row]).cast("array<double>") for row in book.tolist()])
        for book in codebooks.books
    ]
    parts = [
        F.get(table, F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int"))
        for p, table in enumerate(tables)
    ]
    return codes.withColumn("decoded", F.concat(*parts))


def with_label_error(coded):
    """`coded` (staged) with the sum of the errors of all rows that share the label."""
    key = F.coalesce(F.sha2(F.col("label").cast("string"), 256), F.lit(""))
    keyed = coded.withColumn("key", key)
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.when(F.count("error") == F.count(F.lit(1)), total).try_cast("long").alias("label_error")
    totals = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), whole), "labels")
    frequent = F.col("n") > HOT_SHARE * coded.count()
    # A label that holds a large share of the rows is never dealt out by its key.
    hot = totals.where(frequent).select("key", F.col("label_error").alias("hot_error"), F.lit(True).alias("hot"))
    rows = keyed.join(F.broadcast(hot), "key", "left")
    near = rows.where("hot").withColumnRenamed("hot_error", "label_error")
    far = rows.where("hot IS NULL").join(totals.where(~frequent).drop("n"), "key")
    columns = ["vec_id", "code", "error", "label_error"]
    return near.select(*columns).unionByName(far.select(*columns))


def report(table, id_col="vec_id", vector_col="embedding", label_col="label"):
    """Code and error of every kept row, the error of its label, the digest of the codebooks."""
    rows = kept(table, id_col, vector_col, label_col)
    codebooks = fit(rows)
    coded = staged(encode(rows, codebooks), "codes")
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(codebooks.digest()))
