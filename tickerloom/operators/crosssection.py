"""Operators across the symbols of one date, and the training-set transforms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import clip, zscore_of
from ..schema import STD_EPS
from .lineage import join_by_date
from .ordered import over_symbols, quantiles, with_average_rank

SMOOTH_ROWS = 5
DECILES = 10
# Columns from which on z-scores are taken in an array.
WIDE = 10


def date_statistics(df, columns):
    """One row per date: `_rows`, and for each column its `n` present values, `mean` and `dev`."""
    return df.groupBy("date").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("dev")).alias(c)
            for c in columns
        ],
    )


def cross_section_zscore(df, columns, eps=STD_EPS, daily=None):
    """(x - mean) / (deviation + eps) per date, in place for every listed column.

    One aggregate per date carries all means and deviations; the rows are not shuffled. `daily`
    are the `date_statistics` of the columns, if they are known.
    """
    if daily is not None:
        stats = daily.select(
            "date",
            *[F.col(f"`{c}`.{name}").alias(f"_{name}_{c}") for name in ("mean", "dev") for c in columns],
        )
        joined = df.join(stats, "date", "left")
    else:
        stats = df.groupBy("date").agg(
            *[F.avg(c).alias(f"_mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"_dev_{c}") for c in columns],
        )
        joined = join_by_date(df, stats)
    if len(columns) > WIDE:
        # One projection with the formula of every column is too large for the JVM to compile.
        parts = [
            F.struct(F.col(f"`{c}`").cast("double").alias("x"), F.col(f"`_mean_{c}`").alias("m"), F.col(f"`_dev_{c}`").alias("d"))
            for c in columns
        ]
        scores = F.transform(F.array(*parts), lambda p: zscore_of(p["x"], p["m"], p["d"], eps))
        place = {c: k for k, c in enumerate(columns)}
        return joined.withColumn("_scores", scores).select(
            *[F.col("_scores")[place[c]].alias(c) if c in place else F.col(c) for c in df.columns]
        )
    return joined.select(
        *[
            zscore_of(c, f"_mean_{c}", f"_dev_{c}", eps).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def add_rank_pct(df, value, name="rank_pct", ties=("symbol",), counted=False, **skew):
    """Average rank of `value` within its date over the number of present values.

    Rows without a value get NULL. `counted` says that `df` already has `_rows` and
    `_present`, the rows and present values of the date.
    """
    if not counted:
        counts = df.groupBy("date").agg(
            F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_present")
        )
        df = join_by_date(df, counts)
    # NULL values are numbered first.
    rank = "(_rank - (_rows - _present)) / _present"
    return (
        with_average_rank(df, ["date"], value, list(ties), **skew)
        .withColumn(name, F.expr(f"CASE WHEN {value} IS NOT NULL THEN {rank} END"))
        .drop("_rank", "_rows", "_present")
    )


def add_deciles(df, value="prediction", bins=DECILES, ties=("symbol",), min_rows=0, **skew):
    """Adds `decile`, 0 to bins - 1: intervals between the date's interpolated quantiles.

    Equal edges are merged, so equal values always share a bin. NULL for a missing value,
    a date whose values are all equal, and a date with fewer than `min_rows` rows.
    """
    rows = df.groupBy("date").agg(F.count(F.lit(1)).alias("_rows"))
    edges = quantiles(
        df,
        ["date"],
        value,
        # Multiples of the step: 3 * 0.1 is a little above 0.3, and a quantile that is a
        # little above a value is an edge of its own.
        [i * (1 / bins) for i in range(bins + 1)],
        list(ties),
        join_by_date,
        **skew,
    ).select("date", F.array_distinct("_quantiles").alias("_edges"))
    usable = join_by_date(edges, rows).where(
        (F.size("_edges") > 1) & (F.col("_rows") >= min_rows)
    )
    below = F.size(F.filter("_edges", lambda edge: edge < F.col(value)))
    decile = F.when(
        F.col("_edges").isNotNull() & F.col(value).isNotNull(), F.greatest(below - 1, F.lit(0))
    )
    return (
        join_by_date(df, usable.drop("_rows"))
        .withColumn("decile", decile.cast("bigint"))
        .drop("_edges")
    )


def add_time_decay(df, strength=1.5, daily=None):
    """`time_rank`, the average percent rank of `date` over all rows, and `sample_weight`.

    `daily` has the number of `_rows` of each date, if it is known.
    """
    daily = df.groupBy("date").agg(F.count(F.lit(1)).alias("_rows")) if daily is None else daily
    per_date = daily.where(F.col("date").isNotNull()).select("date", F.col("_rows").alias("_n"))
    # One row per date: small enough for a single ordered window.
    upto = F.sum("_n").over(Window.orderBy("date"))
    total = F.sum("_n").over(Window.partitionBy())
    ranks = per_date.select(
        "date",
        ((F.lit(2) * upto - F.col("_n") + F.lit(1)) / F.lit(2.0) / total).alias("time_rank"),
    )
    return join_by_date(df, ranks).withColumn(
        "sample_weight", F.exp(F.lit(float(strength)) * F.col("time_rank"))
    )


def add_smooth_target(df, target="target_5", limit=3.0, **skew):
    """`target_smooth`: mean of the symbol's last 5 targets, clipped to +/- `limit`."""

    def smooth(rows, w):
        mean = F.avg(target).over(w.rowsBetween(-(SMOOTH_ROWS - 1), 0))
        return rows.withColumn("target_smooth", clip(mean, -limit, limit))

    return over_symbols(df, smooth, before=SMOOTH_ROWS - 1, **skew)


def standardise(df, column, fit_on=None, eps=STD_EPS, daily=None):
    """(x - mean) / (deviation + eps) over all rows of `fit_on` (default: `df` itself).

    `daily` are the `date_statistics` of those rows, if they are known.
    """
    if daily is not None:
        of = {part: F.col(f"`{column}`.{part}") for part in ("n", "mean", "dev")}
        total = daily.agg(F.sum(of["n"]).alias("v")).scalar()
        mean = daily.agg((F.sum(of["n"] * of["mean"]) / F.nullif(F.sum(of["n"]), F.lit(0))).alias("v")).scalar()
        within = F.when(of["n"] > 1, of["dev"] * of["dev"] * (of["n"] - 1)).otherwise(F.lit(0.0))
        between = of["n"] * (of["mean"] - mean) * (of["mean"] - mean)
        spread = daily.where(of["n"] > 0).agg(F.sum(within + between).alias("v")).scalar()
        dev = F.when(total > 1, F.sqrt(spread / (total - 1)))
    else:
        source = df if fit_on is None else fit_on
        mean = source.agg(F.avg(column).alias("v")).scalar()
        dev = source.agg(F.stddev_samp(column).alias("v")).scalar()
    return df.withColumn(column, zscore_of(column, mean, dev, eps))
