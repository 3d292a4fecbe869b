"""Intermediate results as Parquet in the folder that the driver and all executors share."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

SETTING = "spark.checkpoint.dir"
# Folder of the scratch that is open, if any.
_SCRATCH = ContextVar("scratch", default=None)


def shared_folder(spark):
    """The folder named by `spark.checkpoint.dir`.

    Where it is unset, a local session (tests) gets a folder of its own; a cluster
    session raises an error, since its executors share no local folder.
    """
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark, name):
    """A path below the shared folder that no other run uses."""
    above = _SCRATCH.get() or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return f"{above}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark):
    """Stages written inside are deleted at the end; tables to keep are written elsewhere."""
    folder = new_folder(spark, "scratch")
    outer = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(outer)
        delete(spark, folder)


def delete(spark, folder):
    """Delete a folder made by `new_folder`."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df, name="stage", compression="zstd", path=None):
    """Write `df` as Parquet and read it back: a lost executor costs nothing that is done."""
    path = path or new_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
