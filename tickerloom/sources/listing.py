"""Names and sizes of files, listed by tasks.

Each round lists the folders that the round before found, one task for many folders, and writes what
it sees as a stage; so no file is named by the driver, and a lost executor costs the folders it had.
Files without any bytes, which Spark's own sources leave out, are listed as well.
"""

import fnmatch
import re

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import functions as F

from .stages import staged

FILES = "path string, file_name string, length long, folder boolean"


def _look(batches):
    for batch in batches:
        rows = []
        for folder in batch.column("path").to_pylist():
            system, name = pyarrow.fs.FileSystem.from_uri(folder)
            start = folder[: len(folder) - len(name)] if folder.endswith(name) else ""
            selector = pyarrow.fs.FileSelector(name, allow_not_found=True)
            for info in system.get_file_info(selector):
                inside = info.type == pyarrow.fs.FileType.Directory
                rows.append((start + info.path, info.base_name, info.size or 0, inside))
        columns = zip(*rows) if rows else [[]] * 4
        kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "file_name", "length", "folder"]
        )


def list_files(spark, folders, pattern="*", recursive=False):
    """path, file_name, length of the files whose name matches the pattern, below the given folders.

    A folder that doesn't exist holds no files. Folders must be paths that `pyarrow.fs` can open.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = spark.createDataFrame([(f.rstrip("/"),) for f in folders], "path string")
    files = None
    while True:
        seen = staged(work.repartition(parts, "path").mapInArrow(_look, FILES), "listing")
        found = seen.where("not folder")
        files = found if files is None else files.unionByName(found)
        work = seen.where("folder").select("path")
        if not recursive or work.isEmpty():
            break
    # As a shell does: a name that begins with a dot only matches a pattern that does.
    expression = re.sub(r"\(\?s:(.*)\)\\[zZ]", r"(?s)^\1$", fnmatch.translate(pattern))
    hidden = F.startswith("file_name", F.lit(".")) & F.lit(not pattern.startswith("."))
    return files.where(F.rlike("file_name", F.lit(expression)) & ~hidden).select("path", "file_name", "length")
