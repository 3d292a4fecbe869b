"""Which ticker files belong to a symbol list."""

from pyspark.sql import functions as F

from ..functions.names import TICKER_SUFFIX, extract_ticker
from ..functions.numeric import count_where
from .lineage import checked_broadcast

EMPTY_THRESHOLD = 50


def symbol_set(df):
    """Distinct upper-case symbols: column `Symbol`, or else the first column."""
    c = "Symbol" if "Symbol" in df.columns else df.columns[0]
    text = F.col(f"`{c}`").cast("string")
    return (
        df.where(text.isNotNull() & (F.trim(text) != ""))
        .select(F.trim(F.upper(text)).alias("ticker"))
        .distinct()
    )


def with_ticker(manifest):
    """`manifest` has file_name and length; files without a ticker are left out."""
    return manifest.withColumn("ticker", extract_ticker("file_name")).where(F.col("ticker") != "")


def matched_files(manifest, symbols):
    """Non-empty files of the listed symbols in ticker order.

    `file_path` is relative to the data folder.
    """
    files = with_ticker(manifest).where(F.col("length") > 0)
    listed = files.join(checked_broadcast(symbols), "ticker", "left_semi")
    return listed.select("ticker", "file_name", file_path()).orderBy("ticker", "file_name")


def file_path():
    return F.concat(F.lit("Stocks/"), "file_name").alias("file_path")


def empty_files(manifest, symbols=None):
    """Empty files; only those of the listed symbols if a list is given."""
    files = with_ticker(manifest).where(F.col("length") == 0)
    if symbols is not None:
        files = files.join(checked_broadcast(symbols), "ticker", "left_semi")
    return files.select("ticker", "file_name", file_path()).orderBy("ticker", "file_name")


def missing_symbols(manifest, symbols):
    """Listed symbols without any file."""
    return symbols.join(with_ticker(manifest).select("ticker").distinct(), "ticker", "left_anti")


def filter_summary(manifest, symbols, empty_threshold=EMPTY_THRESHOLD):
    """One row of counts, and how empty files are handled: ignore, or skip above the threshold."""
    files = manifest.where(F.endswith(F.lower("file_name"), F.lit(TICKER_SUFFIX)))
    listed = files.withColumn("ticker", extract_ticker("file_name")).join(
        checked_broadcast(symbols.withColumn("_listed", F.lit(True))), "ticker", "left"
    )
    empty = (F.col("length") == 0) & (F.col("ticker") != "")
    filled = (F.col("length") > 0) & (F.col("ticker") != "")
    on_list = F.coalesce("_listed", F.lit(False))
    n_symbols = symbols.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        listed.agg(
            F.count(F.lit(1)).alias("total_files"),
            count_where(empty).alias("empty_files"),
            count_where(on_list & filled).alias("matched_files"),
            count_where(on_list & empty).alias("matched_empty_files"),
        )
        .withColumn("symbols", n_symbols)
        .withColumn("mode", F.when(F.col("empty_files") <= empty_threshold, "ignore").otherwise("skip"))
    )


def universe_bars(bars, symbols):
    """Bars of the listed symbols."""
    return bars.join(
        checked_broadcast(symbols.withColumnRenamed("ticker", "symbol")), "symbol", "left_semi"
    )

