"""Per-ticker CSV files and the symbol list."""

import posixpath

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import TICKER_SUFFIX, extract_symbol
from ..operators.cleaning import parse_date
from ..operators.lineage import checked_broadcast
from ..schema import RAW_BARS
from .listing import list_files
from .stages import staged

# Columns that all files of a folder may have.
MOST_COLUMNS = 20_000
RAW = "_raw"

# Label and folder of each kind of instrument.
FOLDERS = {"stocks": ("stock", "Stocks"), "etfs": ("etf", "ETFs")}


def source_folders(base, kind="both"):
    """(label, folder) pairs for `stocks`, `etfs` or `both`."""
    if kind not in ("both", *FOLDERS):
        raise ValueError(f"unknown kind: {kind}")
    return [
        (label, posixpath.join(base, folder))
        for name, (label, folder) in FOLDERS.items()
        if kind in (name, "both")
    ]


def _hadoop(spark, path):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark, path):
    hadoop_path, fs = _hadoop(spark, path)
    return bool(fs.exists(hadoop_path))


def file_manifest(spark, folder, pattern="*" + TICKER_SUFFIX):
    """path, file_name and length of the matching files, empty ones included.

    Tasks list the folder; where they can't open the file system, the driver asks Hadoop's.
    """
    try:
        pyarrow.fs.FileSystem.from_uri(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        hadoop_path, fs = _hadoop(spark, posixpath.join(folder, pattern))
        found = fs.globStatus(hadoop_path) or []
        rows = [(s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in found]
        return spark.createDataFrame(rows, "path string, file_name string, length bigint")
    return list_files(spark, [folder], pattern)


def _cells(line, width):
    """The trimmed cells of a CSV record, quotes and doubled quotes resolved, at most `width`."""
    cells = F.from_csv(line, ", ".join(f"c{k} string" for k in range(width)), {"escape": '"'})
    return F.array(*[F.trim(cells[f"c{k}"]) for k in range(width)])


def _records(spark, folder, pattern, width, multi_line, header):
    """file_path, file_name, number, cells (`width` of them) and raw text of every record.

    The reader keeps the text of records that haven't exactly as many cells as its schema. `number`
    rises by one from record to record of a file that isn't split.
    """
    cells = [f"c{k}" for k in range(width)]
    reader = (
        spark.read.schema(", ".join(f"{c} string" for c in [*cells, RAW]))
        .option("pathGlobFilter", pattern)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", RAW)
        .option("maxColumns", max(MOST_COLUMNS, width) + 1)
        .option("ignoreCorruptFiles", True)
    )
    return reader.csv(folder).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.monotonically_increasing_id().alias("number"),
        F.array(*cells).alias("cells"),
        F.col(RAW).alias("raw"),
    )


def _headers(spark, folder, pattern, multi_line, required):
    """file_path, file_name, header (raw), names and width of every file; `ok` if it has the column.

    One record is read with a schema of one cell, so the raw text of the first one is the header.
    """
    first = _records(spark, folder, pattern, 1, multi_line, False).select(
        "file_path", "file_name", "number", F.coalesce("raw", F.get("cells", F.lit(0))).alias("header")
    )
    found = first.where(F.trim("header") != "").groupBy("file_path", "file_name").agg(
        F.min_by("header", "number").alias("header")
    )
    headers = staged(found, "headers")
    width = headers.agg(F.max(F.regexp_count("header", F.lit(",")))).first()[0]
    width = min((width or 0) + 1, MOST_COLUMNS)
    names = F.transform(_cells(F.col("header"), width), lambda c: F.when(c != "", c))
    return (
        headers.withColumn("names", names)
        .withColumn("keys", F.transform("names", F.lower))
        .withColumn("ok", F.coalesce(F.array_contains("keys", required.lower()), F.lit(False)))
        # Places of the columns that have a name.
        .withColumn("width", F.array_max(F.transform("names", lambda c, k: F.when(c.isNotNull(), k + 1)))),
        width,
    )


def _judged(spark, folder, pattern, multi_line, headers, width):
    """The records of files with a header, and why a record can't be taken (`reason`)."""
    records = _records(spark, folder, pattern, width + 1, multi_line, True)
    known = headers.where("ok").select("file_path", "keys", F.col("width").alias("columns"))
    rows = records.join(checked_broadcast(known), "file_path")
    trimmed = F.transform("cells", lambda c: F.trim(c))
    beyond = F.exists(F.slice("cells", F.col("columns") + 1, width + 1), lambda c: F.coalesce(c != "", F.lit(False)))
    # Cells of the text outside of quotes, without empty ones at its end.
    bare = F.regexp_replace(F.regexp_replace("raw", F.lit(r'"([^"]|"")*"'), F.lit("q")), F.lit(r"[,\s]+$"), F.lit(""))
    more = beyond | F.coalesce(F.regexp_count(bare, F.lit(",")) >= F.col("columns"), F.lit(False))
    odd = F.coalesce(F.regexp_count("raw", F.lit('"')) % 2 == 1, F.lit(False))
    reason = F.when(odd, "a quote is not closed").when(more, "more cells than columns")
    blank = F.forall(trimmed, lambda c: F.coalesce(c == "", F.lit(True)))
    return rows.where(~blank).withColumn("cells", trimmed).withColumn("reason", reason)


def _typed(rows, names, schema):
    """The columns of `names` by their place in the header of each record's file."""
    types = {f.name: f.dataType for f in schema.fields}

    def cell(name):
        at = F.array_position("keys", F.lit(name.lower())).cast("int")
        text = F.when(at > 0, F.get("cells", at - 1))
        text = F.when(text != "", text)
        kind = types.get(name, T.StringType())
        if isinstance(kind, T.IntegralType):
            # Written as a whole number, or as one with decimals that are zero.
            exact = text.try_cast("decimal(38,9)")
            whole = F.when(exact == F.floor(exact), exact)
            return F.coalesce(text.try_cast(kind), whole.try_cast(kind)).alias(name)
        return text.try_cast(kind).alias(name)

    return rows.select(*[cell(n) for n in names], "file_name")


def read_with_rejects(spark, folder, pattern="*.txt", schema=RAW_BARS, required="Date", multi_line=True):
    """(rows, rejects) of all files of a folder, each read by the column names in its own first record.

    Columns are matched by name, in any letter case, so files may order them differently or lack
    some (NULL); further columns are kept as text. `rows` has `file_name`. A numeric cell that cannot
    be read is NULL. Quoted cells may hold commas, doubled quotes and line ends; a file is then read
    by one task. With `multi_line=False` no cell has a line end, and large files are split.

    `rejects` has file_name, record (1 is the header; NULL for a whole file, and for files that may
    be split), reason and text: files that are empty, can't be read, or whose first record lacks the
    `required` column, records with more cells than columns, and those with a quote that isn't closed.
    """
    headers, width = _headers(spark, folder, pattern, multi_line, required)
    names = _column_names(headers.where("ok"), schema)
    judged = _judged(spark, folder, pattern, multi_line, headers, width)
    rows = _typed(judged.where("reason IS NULL"), names, schema)

    # A record with exactly one cell more than the widest header comes without its text.
    text = F.coalesce("raw", F.array_join("cells", ","))
    bad = judged.where("reason IS NOT NULL").select("file_path", "file_name", "number", "reason", text.alias("text"))
    firsts = _records(spark, folder, pattern, width + 1, multi_line, True).groupBy("file_path").agg(
        F.min("number").alias("first")
    )
    record = F.col("number") - F.col("first") + 2 if multi_line else F.lit(None).cast("long")
    of_records = bad.join(firsts, "file_path").select("file_name", record.alias("record"), "reason", "text")
    of_headers = headers.where("not ok").select(
        "file_name", F.lit(None).cast("long").alias("record"),
        F.lit(f"no column {required} in the first record").alias("reason"), F.col("header").alias("text"),
    )
    missing = file_manifest(spark, folder, pattern).join(headers.select("file_name"), "file_name", "left_anti")
    of_files = missing.select(
        "file_name", F.lit(None).cast("long").alias("record"),
        F.when(F.col("length") == 0, "empty").otherwise("no record can be read").alias("reason"),
        F.lit(None).cast("string").alias("text"),
    )
    return rows, of_records.unionByName(of_headers).unionByName(of_files)


def read_by_header(spark, folder, pattern="*.txt", schema=RAW_BARS, required="Date", multi_line=True):
    """The rows of `read_with_rejects`."""
    headers, width = _headers(spark, folder, pattern, multi_line, required)
    names = _column_names(headers.where("ok"), schema)
    judged = _judged(spark, folder, pattern, multi_line, headers, width)
    return _typed(judged.where("reason IS NULL"), names, schema)


def _column_names(headers, schema):
    """The schema's columns, then every other name found in a header, by its first spelling."""
    own = [c.lower() for c in schema.names]
    cells = headers.select(F.explode(F.arrays_zip("names", "keys")).alias("c")).select("c.*")
    others = cells.where(F.col("keys").isNotNull() & ~F.col("keys").isin(own)).groupBy("keys").agg(
        F.min("names").alias("name")
    )
    found = others.limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} different column names")
    return [*schema.names, *sorted(r["name"] for r in found)]


def merge_with_rejects(spark, base, kind="both"):
    """`merge_folders`, and the rejects of all its folders."""
    found = [read_with_rejects(spark, folder) for _, folder in _present(spark, base, kind)]
    rejects = found[0][1]
    for _, more in found[1:]:
        rejects = rejects.unionByName(more)
    labels = [label for label, _ in _present(spark, base, kind)]
    return _merged(zip(labels, (rows for rows, _ in found))), rejects


def _present(spark, base, kind):
    found = [(label, f) for label, f in source_folders(base, kind) if folder_exists(spark, f)]
    if not found:
        raise FileNotFoundError(f"no data folder below {base}")
    return found


def _merged(parts):
    merged = None
    for label, bars in parts:
        tagged = bars.withColumn("symbol", extract_symbol("file_name")).withColumn("type", F.lit(label))
        tagged = tagged.drop("file_name")
        merged = tagged if merged is None else merge_sources(merged, tagged)
    return merged


def merge_folders(spark, base, kind="both"):
    """All ticker files below `base` with `symbol` and `type`; absent folders are skipped."""
    return _merged((label, read_by_header(spark, f)) for label, f in _present(spark, base, kind))


def merge_sources(left, right):
    """Union by column name; columns of one side only are NULL on the other."""
    return left.unionByName(right, allowMissingColumns=True)


def read_ticker(spark, folder, ticker):
    """The file of one ticker, upper or lower case, with `Date` as DATE (NULL if unreadable)."""
    name = ticker.strip().upper()
    for candidate in (name, name.lower()):
        pattern = candidate + TICKER_SUFFIX
        if not folder_exists(spark, posixpath.join(folder, pattern)):
            continue
        bars = read_by_header(spark, folder, pattern)
        if bars.where(F.col("Date").isNotNull()).isEmpty():
            raise ValueError("expected a 'Date' column")
        return bars.withColumn("Date", parse_date("Date")).drop("file_name")
    raise FileNotFoundError(posixpath.join(folder, name + TICKER_SUFFIX))


def read_symbols(spark, path):
    """The symbol list file; see `universe.symbol_set`."""
    return spark.read.csv(path, header=True)
