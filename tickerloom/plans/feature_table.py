"""The complete feature table out of bars."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import features as f
from ..operators import regime
from ..operators.lineage import cut_lineage, join_by_date
from ..operators.ordered import (
    ROWS_PER_TASK,
    count_groups,
    cut_points,
    group_sizes,
    over_symbols,
    with_neighbours,
)
from ..operators.rolling import add_rolling, drop_rolling, mean_name
from ..operators.sampling import recent_dates, recent_rows
from ..schema import TARGETS, require_columns

ROLLED = ["close", "return_1d", "_level"]
# With these and the bar itself, every feature has a value: the longest window covers the
# shorter ones, and the divisors are a mean price or not negative before EPS is added.
# Checking them keeps the filter small and ahead of the feature expressions.
COMPLETE_IF = ["return_5d", mean_name("close", 50), mean_name("return_1d", 50), *TARGETS]


def _numbered_returns(rows, w):
    """symbol, date, `return_1d`, and `_left`, the rows of the symbol behind this one."""
    of_symbol = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = f.return_columns(rows, w).withColumn("_left", of_symbol - F.row_number().over(w))
    return rows.drop("close", "return_5d")


def feature_table(
    bars,
    date_frac=1.0,
    scope="row_order",
    by_rows=True,
    drop_missing=True,
    sizes=None,
    rows_per_task=ROWS_PER_TASK,
    symbols_per_task=regime.SYMBOLS_PER_TASK,
):
    """Bars with returns, momentum, volatility, z-scores, market regime, combinations, targets.

    `date_frac` keeps the latest part of the rows (`by_rows`) or of the distinct dates.
    The daily market level comes from a pass over (symbol, date, close); then one exchange
    and one sort by symbol and date serve every window.
    """
    require_columns(bars, ["symbol", "date", "close"])
    bars = (recent_rows if by_rows else recent_dates)(bars, date_frac)
    sizes = group_sizes(bars, ["symbol"]) if sizes is None else sizes
    symbols, largest = count_groups(sizes)
    by_symbol = (["symbol"], ["date"])
    points = cut_points(bars, *by_symbol, sizes, rows_per_task) if largest > rows_per_task else None

    closes = bars.select("symbol", "date", "close")
    many = symbols > symbols_per_task
    if scope == "row_order" and many and points is None:
        # The market level and the tails of the symbols come from one pass over the closes.
        returns = cut_lineage(over_symbols(closes, _numbered_returns, before=1, points=points))
        daily = cut_lineage(regime.daily_volatility(returns))
        last_rows = returns.where(F.col("_left") < regime.CARRIED_ROWS)
    else:
        returns = over_symbols(closes, f.return_columns, before=1, points=points)
        daily = regime.daily_volatility(returns.select("date", "return_1d"))
        last_rows = bars

    rows = with_neighbours(
        join_by_date(bars, daily),
        *by_symbol,
        before=f.REACH_BACK,
        after=f.REACH_AHEAD,
        points=points,
    )
    w = Window.partitionBy("symbol", "_chunk").orderBy("date")
    rows = f.target_columns(f.return_columns(rows, w), w)
    rows = regime.level_columns(rows, w)
    rows = add_rolling(rows, w, ROLLED, deviations=ROLLED[:2]).where(~F.col("_halo")).drop("_halo")
    if drop_missing:
        rows = f.drop_incomplete(rows, [*bars.columns, *COMPLETE_IF])
    if scope == "row_order":
        carried = regime.carried_levels(last_rows, daily, many, symbols_per_task)
        rows = regime.finish_row_order(rows, carried, many)
    else:
        rows = regime.finish_within_symbol(rows)
    if drop_missing:
        rows = rows.where(F.col("market_vol_regime").isNotNull())
    rows = f.zscore_columns(f.volatility_columns(f.momentum_columns(rows.drop("_chunk"))))
    rows = f.add_alpha_combos(drop_rolling(rows, ROLLED))
    return rows.select(*[c for c in rows.columns if c not in TARGETS], *TARGETS)
