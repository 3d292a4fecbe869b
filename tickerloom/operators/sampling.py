"""Row filters: recent dates, history length, samples, splits.

Cut-off dates are scalar subqueries over one-row-per-date tables, compared with the
bare `date` column.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schema import MIN_HISTORY_ROWS, SEED
from .lineage import checked_broadcast

HASH_PREFIX = 5


def date_quantile(df, q, daily=None):
    """Row-weighted, linearly interpolated quantile of `date`, in days since 1970 (one row).

    `daily` has the number of `_rows` of each date, if it is known.
    """
    daily = df.groupBy("date").agg(F.count(F.lit(1)).alias("_rows")) if daily is None else daily
    return daily.where(F.col("date").isNotNull()).agg(
        F.percentile(F.unix_date("date"), F.lit(float(q)), F.col("_rows")).alias("day")
    )


def recent_rows(df, frac):
    """Rows on or after the (1 - frac) quantile of all rows' dates."""
    if frac >= 1:
        return df
    first = date_quantile(df, 1 - frac).select(
        F.date_from_unix_date(F.ceil("day").cast("int")).alias("first")
    )
    return df.where(F.col("date") >= first.scalar())


def recent_dates(df, frac):
    """Rows of the latest `frac` of the distinct dates."""
    if frac >= 1:
        return df
    if frac <= 0:
        raise ValueError("frac must be above 0")
    dates = df.select("date").where(F.col("date").isNotNull()).distinct()
    numbered = dates.select(
        "date",
        F.row_number().over(Window.orderBy("date")).alias("_k"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"),
    )
    first = numbered.where(
        F.col("_k") - 1 == F.floor(F.col("_n") * F.lit(1 - frac))
    ).select("date")
    return df.where(F.col("date") >= first.scalar())


def latest_date(df):
    """Rows of the last date."""
    return df.where(F.col("date") == df.agg(F.max("date").alias("last")).scalar())


def split_flag(df, q=0.8, daily=None):
    """Adds `is_test`: dates after the `q` quantile of all rows' dates, which `daily` counts if it is known."""
    last_train = date_quantile(df, q, daily).select(
        F.date_from_unix_date(F.floor("day").cast("int")).alias("last")
    )
    return df.withColumn("is_test", F.col("date") > last_train.scalar())


def train_test_split(df, q=0.8):
    flagged = split_flag(df, q)
    return (
        flagged.where(~F.col("is_test")).drop("is_test"),
        flagged.where("is_test").drop("is_test"),
    )


def min_history(df, rows=MIN_HISTORY_ROWS):
    """Rows of the symbols that have at least `rows` rows."""
    enough = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= rows)
    return df.join(checked_broadcast(enough.select("symbol")), "symbol", "left_semi")


def min_history_in_place(df, rows=MIN_HISTORY_ROWS):
    """As `min_history`, in one pass over `df`: a symbol's rows are counted where its windows run."""
    of_symbol = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    return (
        df.where(F.col("symbol").isNotNull())
        .withColumn("_n", of_symbol)
        .where(F.col("_n") >= rows)
        .drop("_n")
    )


def _hash_of(columns, seed):
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def smallest_hashes(df, columns, n, seed=SEED):
    """Exactly `n` rows (or all, if fewer): those with the smallest md5 of `columns` and seed.

    `n` is a number or a one-row table. Counts per hash prefix tell which prefix holds
    the n-th row, so only the rows of that prefix are sorted.
    """
    hashed = df.withColumn("_hash", _hash_of(columns, seed)).withColumn(
        "_prefix", F.substring("_hash", 1, HASH_PREFIX)
    )
    # At most 16 ** HASH_PREFIX rows.
    per_prefix = hashed.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_prefix"))
    limit = n.scalar() if hasattr(n, "scalar") else F.lit(n)
    last = (
        per_prefix.withColumn("_upto", upto)
        .withColumn("_left", limit - (F.col("_upto") - F.col("_n")))
        .where((F.col("_left") > 0) & (F.col("_left") <= F.col("_n")))
    )
    prefix = F.coalesce(last.select("_prefix").scalar(), F.when(limit > 0, "g").otherwise(""))
    left = last.select("_left").scalar()
    whole = hashed.where(F.col("_prefix") < prefix)
    in_prefix = Window.partitionBy("_prefix").orderBy("_hash", *columns)
    part = (
        hashed.where(F.col("_prefix") == prefix)
        .withColumn("_k", F.row_number().over(in_prefix))
        .where(F.col("_k") <= left)
        .drop("_k")
    )
    return whole.unionByName(part).drop("_hash", "_prefix")


def sample_rows(df, n, keys=("symbol", "date"), seed=SEED):
    """Exactly `n` rows, or `df` itself if it has no more."""
    return smallest_hashes(df, list(keys), n, seed)


def sample_symbols(df, frac, seed=SEED):
    """All rows of `int(symbols * frac)` symbols; no sampling if `frac` is 0 or None."""
    if not frac:
        return df
    symbols = df.select("symbol").where(F.col("symbol").isNotNull()).distinct()
    n = symbols.agg(F.floor(F.count(F.lit(1)) * F.lit(float(frac))).alias("n"))
    chosen = smallest_hashes(symbols, ["symbol"], n, seed)
    return df.join(checked_broadcast(chosen), "symbol", "left_semi")
