"""Per-symbol features of daily bars.

All windows share one partitioning and one order, so Spark plans one exchange and one
sort for them.
"""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..functions.numeric import is_finite, relative_change, safe_div
from ..schema import ROLL_WINDOWS, TARGET_HORIZONS, floating_columns, require_columns
from .ordered import over_symbols
from .rolling import add_rolling, deviation, drop_rolling, mean_name

# Rows a feature reaches back: the longest volatility window, whose first return
# needs one more close.
REACH_BACK = max(ROLL_WINDOWS)
REACH_AHEAD = max(TARGET_HORIZONS)


def return_columns(rows, w):
    return rows.withColumns(
        {
            f"return_{k}d": relative_change("close", F.lag("close", k).over(w))
            for k in (1, 5)
        }
    )


def momentum_columns(rows):
    return rows.withColumns(
        {f"ma_ratio_{n}": safe_div("close", mean_name("close", n)) for n in ROLL_WINDOWS}
    )


def volatility_columns(rows):
    return rows.withColumns({f"vol_{n}": deviation("return_1d", n) for n in ROLL_WINDOWS})


def zscore_columns(rows):
    def zscore(n):
        return safe_div(F.col("close") - F.col(mean_name("close", n)), deviation("close", n))

    return rows.withColumns({f"zscore_{n}": zscore(n) for n in ROLL_WINDOWS})


def target_columns(rows, w):
    return rows.withColumns(
        {
            f"target_{h}": relative_change(F.lead("close", h).over(w), "close")
            for h in TARGET_HORIZONS
        }
    )


def add_returns(bars, **cuts):
    """`return_1d`, `return_5d`: change of `close` against 1 and 5 rows earlier."""
    return over_symbols(bars, return_columns, before=5, **cuts)


def _from_rolling(bars, value, add, **cuts):
    def roll(rows, w):
        return add_rolling(rows, w, [value])

    rows = over_symbols(bars, roll, before=REACH_BACK - 1, **cuts)
    return drop_rolling(add(rows), [value])


def add_momentum(bars, **cuts):
    """`ma_ratio_n`: close over its n-row mean, NULL until n rows are there."""
    return _from_rolling(bars, "close", momentum_columns, **cuts)


def add_volatility(bars, **cuts):
    """`vol_n`: sample deviation of `return_1d` over n rows."""
    require_columns(bars, ["return_1d"])
    return _from_rolling(bars, "return_1d", volatility_columns, **cuts)


def add_zscores(bars, **cuts):
    """`zscore_n`: close against mean and deviation of its last n rows."""
    return _from_rolling(bars, "close", zscore_columns, **cuts)


def add_targets(bars, **cuts):
    """`target_h`: change of `close` h rows ahead."""
    return over_symbols(bars, target_columns, after=REACH_AHEAD, **cuts)


def add_alpha_combos(df):
    require_columns(df, ["return_5d", "vol_20", "zscore_20", "ma_ratio_10"])
    return df.withColumns(
        {
            "momentum_vol_adj": safe_div("return_5d", "vol_20"),
            "reversion_strength": -F.col("zscore_20"),
            "combo_momentum": F.col("return_5d") * F.col("ma_ratio_10"),
        }
    )


def drop_incomplete(df, columns=None):
    """Drop rows with a missing, NaN or infinite value in any of the columns (default: all)."""
    columns = df.columns if columns is None else columns
    floats = set(floating_columns(df))
    usable = [is_finite(c) if c in floats else F.col(c).isNotNull() for c in columns]
    return df.where(reduce(and_, usable))
