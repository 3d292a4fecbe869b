"""BUY / SHORT / HOLD signals and the tables of the signal report."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import count_where, zscore_of
from ..schema import STD_EPS
from .crosssection import add_rank_pct
from .lineage import join_by_date
from .sampling import latest_date

HOLDING_DAYS = 5
TOP_NAMES = 20


def add_signals(df, long_pct=0.02, short_pct=0.02, **skew):
    """Adds `pred_z`, `rank_pct`, `signal` and `confidence`.

    SHORT wins where both sides overlap; a name without a rank is HOLD.
    """
    stats = df.groupBy("date").agg(
        F.avg("prediction").alias("_mean"),
        F.stddev_samp("prediction").alias("_dev"),
        F.min("prediction").alias("_low"),
        F.max("prediction").alias("_high"),
        F.count(F.lit(1)).alias("_rows"),
        # Without a deviation there is no score.
        F.when(F.stddev_samp("prediction").isNotNull(), F.count("prediction"))
        .otherwise(0)
        .alias("_present"),
    )
    # The score grows with the prediction, so its extremes are those of the extremes.
    largest = F.greatest(
        F.abs(zscore_of("_low", "_mean", "_dev")), F.abs(zscore_of("_high", "_mean", "_dev"))
    )
    scored = (
        join_by_date(df.drop("rank_pct"), stats)
        .withColumn("pred_z", zscore_of("prediction", "_mean", "_dev"))
        .withColumn("confidence", F.abs("pred_z") / (largest + F.lit(STD_EPS)))
        .drop("_mean", "_dev", "_low", "_high")
    )
    ranked = add_rank_pct(scored, "pred_z", counted=True, **skew)
    signal = (
        F.when(F.col("rank_pct") <= F.lit(short_pct), "SHORT")
        .when(F.col("rank_pct") >= F.lit(1 - long_pct), "BUY")
        .otherwise("HOLD")
    )
    return ranked.withColumn("signal", signal)


def latest_signals(signals, horizon=HOLDING_DAYS):
    """Signals of the last date with the holding period."""
    return latest_date(signals).withColumn("holding_days", F.lit(horizon).cast("bigint"))


def latest_trades(signals, horizon=HOLDING_DAYS, names=TOP_NAMES):
    """The `names` most confident BUY or SHORT rows of the last date."""
    return (
        latest_signals(signals, horizon)
        .where(F.col("signal") != "HOLD")
        .orderBy(F.desc("confidence"), "symbol")
        .limit(names)
        .select("symbol", "signal", "confidence", "holding_days")
    )


def top_signals(signals, names=TOP_NAMES):
    """The `names` most confident rows per side on the last date, with their report line."""
    hold = (
        F.col("holding_days").cast("string") if "holding_days" in signals.columns else F.lit("N/A")
    )
    by_confidence = Window.partitionBy("signal").orderBy(F.desc("confidence"), "symbol")
    return (
        latest_date(signals)
        .where(F.col("signal").isin("BUY", "SHORT"))
        .withColumn("position", F.row_number().over(by_confidence).cast("bigint"))
        .where(F.col("position") <= names)
        .select(
            "signal",
            "position",
            "symbol",
            "confidence",
            F.format_string("%-10s | conf=%.3f | hold=%s", "symbol", "confidence", hold).alias(
                "line"
            ),
        )
    )


def signal_summary(signals):
    """One row about the last date: rows, BUY, SHORT, mean confidence."""
    return latest_date(signals).agg(
        F.max("date").alias("latest_date"),
        F.count(F.lit(1)).alias("total"),
        count_where(F.col("signal") == "BUY").alias("buys"),
        count_where(F.col("signal") == "SHORT").alias("shorts"),
        F.avg("confidence").alias("avg_confidence"),
    )


def top_stocks(predictions, names=TOP_NAMES):
    """The `names` highest predictions of the last date with their weights."""
    return (
        latest_date(predictions)
        .orderBy(F.desc("prediction"), "symbol")
        .limit(names)
        .select("symbol", "prediction", "weight")
    )
