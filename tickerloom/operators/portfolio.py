"""Portfolio weights from predictions, and their performance."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import pearson, sharpe, zscore_of
from ..schema import require_columns
from .lineage import join_by_date
from .ordered import with_position

LONG_PCT = 0.02
COST_PER_TRADE = 0.0005
MIN_GROSS = 1e-12
RETURN_FLOOR = -0.99


def flip_on_negative_ic(df, prediction="prediction", target="target"):
    """Reverse the predictions if their mean daily correlation with the target is negative."""
    p, t = F.col(prediction), F.col(target)
    daily = (
        df.groupBy("date")
        .agg(
            pearson(prediction, target).alias("_ic"),
            F.stddev_samp(p).alias("_p"),
            F.stddev_samp(t).alias("_t"),
        )
        .where((F.col("_p") > MIN_GROSS) & (F.col("_t") > MIN_GROSS))
    )
    mean_ic = daily.agg(F.avg("_ic").alias("v")).scalar()
    return df.withColumn(prediction, F.when(mean_ic < 0, -p).otherwise(p))


def add_portfolio(df, long_pct=LONG_PCT, **skew):
    """Standardise `prediction` per date and weight the top `long_pct` names by their score.

    Adds `rank` (unique, equal predictions in symbol order), `rank_pct` and `weight`; the
    weights of a date sum to 1, or are all 0 if no chosen name has a positive score.
    """
    stats = df.groupBy("date").agg(
        F.avg("prediction").alias("_mean"),
        F.stddev_samp("prediction").alias("_dev"),
        F.count(F.lit(1)).alias("_rows"),
        F.count("prediction").alias("_present"),
    )
    scored = join_by_date(df, stats).withColumn(
        "prediction", zscore_of("prediction", "_mean", "_dev")
    )
    # NULL predictions come first in the numbering.
    rank = F.col("_pos") - (F.col("_rows") - F.col("_present"))
    ranked = (
        with_position(scored, ["date"], ["prediction", "symbol"], **skew)
        .withColumn("rank", F.when(F.col("prediction").isNotNull(), rank.cast("double")))
        .withColumn("rank_pct", F.col("rank") / F.col("_rows"))
        .withColumn(
            "_score",
            F.when(
                F.col("rank_pct") >= F.lit(1 - long_pct), F.greatest("prediction", F.lit(0.0))
            ).otherwise(0.0),
        )
    )
    totals = ranked.groupBy("date").agg(F.sum("_score").alias("_total"))
    weight = F.when(F.col("_total") > MIN_GROSS, F.col("_score") / F.col("_total"))
    return (
        join_by_date(ranked, totals)
        .withColumn("weight", F.coalesce(weight, F.lit(0.0)))
        .drop("_mean", "_dev", "_rows", "_present", "_pos", "_score", "_total")
    )


def daily_pnl(df):
    """One row per traded date: `gross` exposure and `pnl` at gross exposure 1."""
    require_columns(df, ["date", "weight", "target"])
    return (
        df.where(F.col("weight").isNotNull() & F.col("target").isNotNull())
        .groupBy("date")
        .agg(
            F.sum(F.abs("weight")).alias("gross"),
            F.sum(F.col("weight") * F.col("target")).alias("_earned"),
        )
        .where(F.col("gross") >= MIN_GROSS)
        .select("date", "gross", (F.col("_earned") / F.col("gross")).alias("pnl"))
    )


def daily_turnover(df):
    """`daily_pnl` plus `day_idx` (1, 2, ... over traded dates) and `turnover`.

    Turnover is the sum over symbols of |weight - weight on the previous traded date|.
    Every held weight counts for its own day and, negated, for the next one, so one
    aggregate by (day, symbol) replaces the outer join of consecutive days.
    """
    # One row per date: small enough for a single ordered window.
    days = daily_pnl(df).withColumn(
        "day_idx", F.row_number().over(Window.orderBy("date")).cast("bigint")
    )
    held = df.where(
        F.col("weight").isNotNull() & F.col("target").isNotNull() & (F.col("weight") != 0)
    ).select("date", "symbol", "weight")
    scaled = join_by_date(held, days.select("date", "day_idx", "gross"), "inner").select(
        "symbol", "day_idx", (F.col("weight") / F.col("gross")).alias("w")
    )
    moves = scaled.select(
        "symbol",
        F.explode(
            F.array(
                F.struct(F.col("day_idx"), F.col("w")),
                F.struct((F.col("day_idx") + 1).alias("day_idx"), (-F.col("w")).alias("w")),
            )
        ).alias("_m"),
    ).select("symbol", "_m.day_idx", "_m.w")
    traded = (
        moves.groupBy("day_idx", "symbol")
        .agg(F.abs(F.sum("w")).alias("_traded"))
        .groupBy("day_idx")
        .agg(F.sum("_traded").alias("turnover"))
    )
    return days.join(traded, "day_idx")


def daily_returns(df, cost_per_trade=COST_PER_TRADE):
    """One row per traded date: pnl, turnover, `net_return` (at least -0.99) and `equity`."""
    net = F.col("pnl") - F.col("turnover") * F.lit(float(cost_per_trade))
    # One row per date: small enough for a single ordered window.
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily_turnover(df)
        .select("date", "pnl", "turnover", F.greatest(net, F.lit(RETURN_FLOOR)).alias("net_return"))
        .withColumn("equity", F.product(F.lit(1.0) + F.col("net_return")).over(so_far))
    )


def add_drawdown(returns):
    """`peak` and `drawdown` of the `equity` column; one row per date."""
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return returns.withColumn("peak", F.max("equity").over(so_far)).withColumn(
        "drawdown", (F.col("equity") - F.col("peak")) / F.col("peak")
    )


def performance(df, cost_per_trade=COST_PER_TRADE):
    """One row: total return, Sharpe, maximum drawdown, traded and skipped days.

    Zeros if nothing was traded.
    """
    curve = add_drawdown(daily_returns(df, cost_per_trade))
    dates = df.agg(F.count_distinct("date").alias("n")).scalar()
    days = F.count(F.lit(1))
    return curve.agg(
        F.when(days > 0, F.max_by("equity", "date") - F.lit(1.0)).otherwise(0.0).alias("total_return"),
        F.when(days > 0, sharpe("net_return")).otherwise(0.0).alias("sharpe"),
        F.when(days > 0, F.min("drawdown")).otherwise(0.0).alias("max_drawdown"),
        days.alias("traded_days"),
    ).withColumn("skipped_days", dates - F.col("traded_days"))


def long_short(df):
    """One row per date: weighted return of the long side, the short side and both."""
    earned = F.col("weight") * F.col("target")
    return (
        df.groupBy("date")
        .agg(
            F.coalesce(F.sum(F.when(F.col("weight") > 0, earned)), F.lit(0.0)).alias("long_return"),
            F.coalesce(F.sum(F.when(F.col("weight") < 0, earned)), F.lit(0.0)).alias("short_return"),
        )
        .withColumn("ls_return", F.col("long_return") + F.col("short_return"))
    )


def long_short_summary(df):
    """One row: mean side returns, Sharpe and maximum drawdown of the long-short return."""
    daily = long_short(df)
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    curve = add_drawdown(
        daily.withColumn("equity", F.product(F.lit(1.0) + F.col("ls_return")).over(so_far))
    )
    return curve.agg(
        F.avg("long_return").alias("avg_long"),
        F.avg("short_return").alias("avg_short"),
        F.avg("ls_return").alias("avg_long_short"),
        sharpe("ls_return").alias("sharpe"),
        F.min("drawdown").alias("max_drawdown"),
    )


def backtest_checks(df):
    """One row: rows, missing cells, mean weight sum and gross exposure per day, short-only flag."""
    require_columns(df, ["date", "weight", "target"])
    missing = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    per_date = df.groupBy("date").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(missing).alias("_missing"),
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("_net"),
        F.coalesce(F.sum(F.abs("weight")), F.lit(0.0)).alias("_gross"),
        F.max((F.col("weight") > 0)).alias("_long"),
    )
    dated = F.col("date").isNotNull()
    return per_date.agg(
        F.sum("_rows").alias("rows"),
        F.sum("_missing").alias("missing"),
        F.avg(F.when(dated, F.col("_net"))).alias("avg_weight_sum"),
        F.avg(F.when(dated, F.col("_gross"))).alias("avg_gross"),
        (~F.coalesce(F.max("_long"), F.lit(False))).alias("short_only"),
    )
