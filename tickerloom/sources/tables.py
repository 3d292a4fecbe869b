"""Parquet and CSV tables."""

from pyspark.sql import functions as F


def read_table(spark, path):
    return spark.read.parquet(path)


def write_bars(bars, path, by_year=False):
    """Snappy Parquet, ordered by symbol and date across files.

    The range partitioning cuts a large symbol by date, and the order gives readers
    narrow value ranges per row group to skip by.
    """
    placed = bars
    if by_year:
        placed = placed.withColumn("year", F.year("date"))
    lead = ["year"] if by_year else []
    placed = placed.repartitionByRange(*lead, "symbol", "date").sortWithinPartitions(
        *lead, "symbol", "date"
    )
    writer = placed.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy("year") if by_year else writer).parquet(path)


def write_bucketed(bars, name, buckets, path=None):
    """A Parquet table of the catalog with the rows of a symbol in one bucket, sorted by date.

    Windows and aggregates by symbol read it without an exchange, as do joins with a table of as many
    buckets. A symbol has few rows, so buckets are as even as a hash of many symbols makes them.
    """
    writer = (
        bars.repartition(buckets, "symbol")
        .write.mode("overwrite")
        .format("parquet")
        .option("compression", "snappy")
        .bucketBy(buckets, "symbol")
        .sortBy("symbol", "date")
    )
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return bars.sparkSession.table(name)


def write_by_date(df, path):
    """Snappy Parquet, ordered by date and symbol across files."""
    (
        df.repartitionByRange("date", "symbol")
        .sortWithinPartitions("date", "symbol")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(path)
    )


def write_universe(bars, path):
    """One folder per symbol."""
    (
        bars.repartitionByRange("symbol", "date")
        .sortWithinPartitions("symbol", "date")
        .write.mode("overwrite")
        .partitionBy("symbol")
        .parquet(path)
    )


def write_csv(df, path):
    df.write.mode("overwrite").csv(path, header=True)
