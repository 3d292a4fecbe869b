"""Bars, predictions, file lists and raw rows derived from the star-schema tables.

They feed the registered queries: a supplier is a symbol, a ship date a trading day.
"""

from pyspark.sql import functions as F

from .functions.numeric import safe_div
from .operators import features
from .operators.crosssection import cross_section_zscore
from .operators.lineage import cut_lineage
from .operators.ordered import group_sizes, over_symbols
from .operators.rolling import add_rolling, drop_rolling

# Every third supplier is listed, the file of every ninth is empty.
LISTED_EVERY = 3
EMPTY_EVERY = 9


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbol_of(supplier):
    return F.concat(F.lit("S"), F.col(supplier).cast("string"))


def trading_date(calendar):
    """The ship date, or the first day of its month: few dates with many names."""
    day = F.to_date("l_shipdate")
    return (day if calendar == "day" else F.to_date(F.trunc(day, calendar))).alias("date")


def bars(spark, sf_dir, calendar="day"):
    """One bar per supplier and date; only aggregates that do not depend on row order.

    A supplier has hardly more lines than bars, so the lines go to their symbol's task at
    once, where the windows by symbol find the bars without another exchange.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        symbol_of("l_suppkey").alias("symbol"),
        (F.col("l_suppkey") % 2).cast("tinyint").alias("type"),
        trading_date(calendar),
        "l_extendedprice",
        "l_quantity",
    )
    return (
        lines.repartition("symbol")
        .groupBy("symbol", "date")
        .agg(
            F.min("l_extendedprice").alias("low"),
            F.max("l_extendedprice").alias("high"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
            F.count(F.lit(1)).alias("openint"),
            F.max("type").alias("type"),
        )
        .select(
            "symbol",
            "date",
            F.col("low").alias("open"),
            "high",
            "low",
            F.col("high").alias("close"),
            "volume",
            "openint",
            "type",
        )
    )


def symbol_sizes(spark, sf_dir):
    """Upper bound of bars per symbol, from one column of the source."""
    lines = table(spark, sf_dir, "lineitem")
    return group_sizes(lines, ["l_suppkey"]).select(symbol_of("l_suppkey").alias("symbol"), "_rows")


def date_sizes(spark, sf_dir, calendar="day"):
    """Upper bound of bars per date, from one column of the source."""
    lines = table(spark, sf_dir, "lineitem").select(trading_date(calendar))
    return group_sizes(lines, ["date"])


def scored_bars(spark, sf_dir, calendar="day"):
    """date, symbol, return_5d / vol_20 as `prediction`, target_5 as `target`; complete rows."""

    def add(rows, w):
        rows = features.return_columns(rows, w)
        rows = features.target_columns(rows, w)
        rows = features.volatility_columns(add_rolling(rows, w, ["return_1d"]))
        return drop_rolling(rows, ["return_1d"])

    rows = over_symbols(
        bars(spark, sf_dir, calendar).select("symbol", "date", "close"),
        add,
        before=features.REACH_BACK,
        after=features.REACH_AHEAD,
        sizes=symbol_sizes(spark, sf_dir),
    )
    return rows.select(
        "date",
        "symbol",
        safe_div("return_5d", "vol_20").alias("prediction"),
        F.col("target_5").alias("target"),
    ).dropna("any")


def predictions(spark, sf_dir, calendar="day"):
    """`scored_bars` with the prediction as a z-score of its date.

    Written once, as a stage of its own: every use reads it several times.
    """
    scored = cross_section_zscore(scored_bars(spark, sf_dir, calendar), ["prediction"])
    return cut_lineage(scored.dropna("any"))


def raw_bars(spark, sf_dir):
    """Bars as they look before cleaning, with defects placed by rule.

    Zero volume for suppliers divisible by 7, no close on days 11 and 22, infinite high
    on day 17, unreadable dates on days 13 and 26, copies of suppliers divisible by 5.
    """
    b = bars(spark, sf_dir)
    supplier = F.substring("symbol", 2, 20).cast("bigint")
    day = F.dayofmonth("date")
    rows = b.select(
        F.when(day % 13 == 0, "bad").otherwise(F.col("date").cast("string")).alias("Date"),
        F.col("open").alias("Open"),
        F.when(day == 17, F.lit(float("inf"))).otherwise(F.col("high")).alias("High"),
        F.col("low").alias("Low"),
        F.when(day % 11 != 0, F.col("close")).alias("Close"),
        F.when(supplier % 7 == 0, F.lit(0)).otherwise(F.col("volume")).alias("Volume"),
        F.col("openint").alias("OpenInt"),
        "symbol",
        F.when(F.col("type") == 0, "Stock").otherwise("etf").alias("type"),
    )
    copies = F.when(F.substring("symbol", 2, 20).cast("bigint") % 5 == 0, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def file_names(spark, sf_dir):
    """A file name per supplier: `<name>.us.txt` in lower case, or `<NAME>.TXT` for odd keys."""
    name = F.when(
        F.col("s_suppkey") % 2 == 0, F.concat(F.lower("s_name"), F.lit(".us.txt"))
    ).otherwise(F.concat(F.col("s_name"), F.lit(".TXT")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", name.alias("file_name"))


def manifest(spark, sf_dir):
    """A `<name>.us.txt` per supplier; every ninth is empty."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lower("s_name"), F.lit(".us.txt")).alias("file_name"),
        F.when(F.col("s_suppkey") % EMPTY_EVERY == 0, 0)
        .otherwise(F.col("s_suppkey") * 100)
        .cast("bigint")
        .alias("length"),
    )


def symbol_list(spark, sf_dir):
    """Every third supplier in mixed case, and as many names that have no file."""
    listed = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % LISTED_EVERY == 0)
    return listed.select(
        F.explode(
            F.array(
                F.concat(F.lit(" "), F.lower("s_name")),
                F.concat(F.lit("Unlisted"), F.col("s_suppkey").cast("string")),
            )
        ).alias("Symbol")
    )
