"""Checks of features and predictions; every result is a table."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import complete_pearson, count_where, sharpe
from ..schema import MIN_HISTORY_ROWS, SEED, TARGETS, feature_columns, floating_columns
from .crosssection import add_deciles
from .lineage import join_by_date
from .ordered import PERCENTILE_ROWS, with_average_rank
from .portfolio import long_short
from .selection import present_counts, quantiles_of

LOW_VARIANCE = 1e-6
LEAK = 0.95
STRONG = 0.2
FLAT = 0.001


def rows_of(df, entries):
    """Turn a one-row table into one row per struct of `entries`."""
    return df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def column_defects(df):
    """One row per column: missing (NULL or NaN) and infinite values, from one pass."""
    floats = set(floating_columns(df))
    sums = []
    for i, c in enumerate(df.columns):
        missing = F.col(c).isNull()
        infinite = F.lit(False)
        if c in floats:
            missing = missing | F.isnan(c)
            infinite = F.abs(F.col(c)) == F.lit(float("inf"))
        sums += [count_where(missing).alias(f"m{i}"), count_where(infinite).alias(f"i{i}")]
    return rows_of(
        df.agg(*sums),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"m{i}").alias("missing"),
                F.col(f"i{i}").alias("infinite"),
            )
            for i, c in enumerate(df.columns)
        ],
    )


def missing_report(df):
    """Missing values per column."""
    return column_defects(df).select("column_name", "missing")


def nan_inf_check(df, top=10):
    """The columns with most missing values, with the totals of the table and a verdict."""
    # One row per column.
    everything = Window.partitionBy()
    return (
        column_defects(df)
        .withColumn("total_missing", F.sum("missing").over(everything))
        .withColumn("total_infinite", F.sum("infinite").over(everything))
        .withColumn("clean", F.col("total_missing") == 0)
        .orderBy(F.desc("missing"), "column_name")
        .limit(top)
    )


def target_analysis(df, targets=TARGETS, rows_per_task=PERCENTILE_ROWS):
    """Count, mean, deviation, minimum, quartiles, maximum and share of |t| > 1 per target.

    One aggregate without an exchange of rows. Beyond `rows_per_task` values the quartiles are found
    by counting (`selection`), which neither sorts them nor holds them in one place.
    """
    shares = (0.25, 0.5, 0.75)
    counts = present_counts(df, targets)
    few = max(counts.values()) <= rows_per_task
    found = {} if few else quantiles_of(df, targets, shares)
    sums, entries = [], []
    for t in targets:
        extreme = F.coalesce(F.abs(F.col(t)) > 1, F.lit(False)).cast("double")
        values = {
            "n": F.count(t), "mean": F.avg(t), "std": F.stddev_samp(t), "min": F.min(t), "max": F.max(t),
            "extreme": F.avg(extreme),
        }
        if few:
            values["quartiles"] = F.percentile(t, F.array(*map(F.lit, shares)))
        sums += [v.alias(f"{t} {name}") for name, v in values.items()]

        def cell(name, t=t):
            return F.col(f"`{t} {name}`").alias(name)

        def quartile(k, t=t):
            known = F.get(F.col(f"`{t} quartiles`"), F.lit(k)) if few else F.lit(found[t][k])
            return known.cast("double").alias(f"q{round(100 * shares[k])}")

        entries.append(
            F.struct(
                F.lit(t).alias("target"), *map(cell, ("n", "mean", "std", "min")),
                *map(quartile, range(3)), *map(cell, ("max", "extreme")),
            )
        )
    return rows_of(df.agg(*sums), entries).where("n > 0 OR extreme IS NOT NULL")


def feature_quality(df, columns=None):
    """Variance per feature with flags for low (< 1e-6) and zero variance."""
    columns = feature_columns(df) if columns is None else columns
    row = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    return row.unpivot([], columns, "feature", "variance").select(
        "feature",
        "variance",
        F.coalesce(F.col("variance") < LOW_VARIANCE, F.lit(False)).alias("low_variance"),
        F.coalesce(F.col("variance") == 0, F.lit(False)).alias("constant"),
    )


def leakage_check(df, columns=None, targets=TARGETS, top=5):
    """The `top` features by |correlation| with each target.

    A feature with missing values, or without variance, is left out. `verdict` judges
    the strongest feature of the target.
    """
    columns = feature_columns(df) if columns is None else columns
    # One aggregate of all pairs, without the unpivoted rows, takes ten times as long: its code is too large.
    long = df.select(*targets, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(targets), columns, "feature", "x"
    )
    # One row per feature, with one correlation per target.
    row = long.groupBy("feature").agg(
        *[F.abs(complete_pearson("x", t)).alias(t) for t in targets]
    )
    table = row.unpivot(["feature"], list(targets), "target", "abs_corr").where(
        F.col("abs_corr").isNotNull()
    )
    strongest = Window.partitionBy("target").orderBy(F.desc("abs_corr"), "feature")
    judged = F.when(F.col("abs_corr") > LEAK, "leak").when(F.col("abs_corr") > STRONG, "strong")
    verdict = F.when(F.col("position") == 1, judged.otherwise("ok"))
    return (
        table.withColumn("position", F.row_number().over(strongest).cast("bigint"))
        .where(F.col("position") <= top)
        .withColumn("verdict", verdict)
        .select("target", "feature", "abs_corr", "position", "verdict")
    )


def dispersion(df, columns=None, dates=None, seed=SEED):
    """One row: mean over the dates of the mean deviation of the features.

    A caller may ask for a sample of `dates` dates, those with the smallest md5. Dates with
    one row are not used.
    """
    columns = feature_columns(df) if columns is None else columns
    rows = df
    if dates is not None:
        chosen = (
            df.select("date")
            .distinct()
            .orderBy(F.md5(F.concat(F.col("date").cast("string"), F.lit(str(seed)))), "date")
            .limit(dates)
        )
        rows = df.join(F.broadcast(chosen), "date", "left_semi")
    per_date = (
        rows.groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.array(*[F.stddev_samp(c) for c in columns]).alias("_devs"),
        )
        .where(F.col("_n") > 1)
    )
    present = F.filter("_devs", lambda d: d.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda a, d: a + d)
    return per_date.select(F.try_divide(total, F.size(present)).alias("_d")).agg(
        F.count(F.lit(1)).alias("dates"), F.avg("_d").alias("avg_dispersion")
    )


def symbol_health(df, weak_rows=MIN_HISTORY_ROWS):
    """One row: symbols, fewest and most rows per symbol, symbols below `weak_rows`."""
    return (
        df.where(F.col("symbol").isNotNull())
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.count(F.lit(1)).alias("symbols"),
            F.min("_n").alias("min_rows"),
            F.max("_n").alias("max_rows"),
            count_where(F.col("_n") < weak_rows).alias("weak_symbols"),
        )
    )


def daily_ic(df):
    """Correlation of prediction and target per date with more than one row."""
    return (
        df.groupBy("date")
        .agg(F.count(F.lit(1)).alias("n"), complete_pearson("prediction", "target").alias("ic"))
        .where(F.col("n") > 1)
    )


def daily_rank_ic(df, ties=("symbol",), **skew):
    """Correlation of the average ranks of prediction and target per date.

    A date with a missing value has no rank correlation.
    """
    complete = df.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"),
        F.least(F.count("prediction"), F.count("target")).alias("_present"),
    )
    rows = df.where(F.col("prediction").isNotNull() & F.col("target").isNotNull())
    ranked = with_average_rank(
        rows.select("date", "prediction", "target", *ties), ["date"], "prediction", list(ties), **skew
    ).withColumnRenamed("_rank", "_p")
    ranked = with_average_rank(ranked, ["date"], "target", list(ties), **skew)
    per_date = ranked.groupBy("date").agg(complete_pearson("_p", "_rank").alias("_ic"))
    return join_by_date(complete.where(F.col("n") > 1), per_date).select(
        "date", "n", F.when(F.col("_present") == F.col("n"), F.col("_ic")).alias("rank_ic")
    )


def ic_summary(df, **skew):
    """One row: mean and deviation of the daily IC, mean of the daily rank IC."""
    rank_ic = daily_rank_ic(df, **skew).agg(F.avg("rank_ic").alias("v")).scalar()
    return (
        daily_ic(df)
        .agg(F.avg("ic").alias("mean_ic"), F.stddev_samp("ic").alias("std_ic"))
        .withColumn("mean_rank_ic", rank_ic)
    )


def decile_analysis(df, min_rows=10, **skew):
    """Mean over dates of the mean target per prediction decile.

    Uses dates with at least `min_rows` rows and two deciles.
    """
    per_date = (
        add_deciles(df, min_rows=min_rows, **skew)
        .where(F.col("decile").isNotNull())
        .groupBy("date", "decile")
        .agg(F.avg("target").alias("_mean"))
    )
    # At most ten rows per date.
    several = F.count(F.lit(1)).over(Window.partitionBy("date")) > 1
    return (
        per_date.withColumn("_several", several)
        .where("_several")
        .groupBy("decile")
        .agg(F.avg("_mean").alias("avg_return"), F.count("_mean").alias("dates"))
    )


def decile_spread(df, **skew):
    """One row: mean return of the highest decile minus that of the lowest."""
    table = decile_analysis(df, **skew)
    return table.agg(
        F.max_by("avg_return", "decile").alias("top"),
        F.min_by("avg_return", "decile").alias("bottom"),
        F.count(F.lit(1)).alias("deciles"),
    ).select(
        "top",
        "bottom",
        F.when(F.col("deciles") > 1, F.col("top") - F.col("bottom")).alias("spread"),
    )


def prediction_diagnostics(df):
    """One row: mean and deviation of the predictions, mean daily deviation, flatness flag."""
    daily = df.groupBy("date").agg(F.stddev_samp("prediction").alias("_dev"))
    avg_daily = daily.agg(F.avg("_dev").alias("v")).scalar()
    return (
        df.agg(F.avg("prediction").alias("mean"), F.stddev_samp("prediction").alias("std"))
        .withColumn("avg_daily_std", avg_daily)
        .withColumn("flat", F.col("avg_daily_std") < FLAT)
    )


def directional_accuracy(df):
    """One row: share of rows whose prediction and target have the same sign."""
    same = F.signum("prediction") == F.signum("target")
    return df.agg(F.avg(F.coalesce(same, F.lit(False)).cast("double")).alias("accuracy"))


def validation_warnings(df):
    """One row: mean IC and Sharpe with the three warning flags."""
    ls_sharpe = long_short(df).agg(sharpe("ls_return").alias("v")).scalar()
    return (
        daily_ic(df)
        .agg(F.avg("ic").alias("mean_ic"))
        .withColumn("sharpe", ls_sharpe)
        .select(
            "mean_ic",
            "sharpe",
            (F.col("mean_ic") < 0.01).alias("weak_signal"),
            (F.col("mean_ic") > 0.1).alias("suspicious_signal"),
            (F.col("sharpe") > 1).alias("high_sharpe"),
        )
    )
