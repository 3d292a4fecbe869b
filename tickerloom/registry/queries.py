"""The registered queries: every operator over the whole driver tables.

Doubles are rounded to six decimals (`rounded`) or nine significant digits
(`significant`), since two engines add floating point numbers in different orders.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..functions.names import extract_symbol, extract_ticker, ticker_equals
from ..operators import cleaning, crosssection, features, portfolio, quality, regime
from ..operators import sampling, signals, universe
from ..plans import boosting, training
from ..plans import feature_table as plan
from ..sources.stages import staged
from ..sources.ticker_files import merge_sources

LONG_PCT = 0.1
SHORT_PCT = 0.1
# Size of the model that SQL grows too.
BOOSTED_TREES, BOOSTED_LEAVES, BOOSTED_STEP = 2, 8, 0.1


def _doubles(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


def rounded(df):
    """Half-up at six decimals; never a negative zero."""
    doubles = set(_doubles(df))
    return df.select(
        *[
            (F.floor(F.col(c) * 1e6 + 0.5) / F.lit(1e6)).alias(c) if c in doubles else F.col(c)
            for c in df.columns
        ]
    )


def significant(df):
    doubles = set(_doubles(df))
    return df.select(
        *[
            F.format_string("%.8e", c).cast("double").alias(c) if c in doubles else F.col(c)
            for c in df.columns
        ]
    )


def _bars(spark, d):
    return fx.bars(spark, d)


def _by_symbol(spark, d):
    return dict(sizes=fx.symbol_sizes(spark, d))


def _by_date(spark, d, calendar="day"):
    return dict(sizes=fx.date_sizes(spark, d, calendar))


# Features


def returns(spark, d):
    df = features.add_returns(_bars(spark, d), **_by_symbol(spark, d))
    return rounded(df.select("symbol", "date", "return_1d", "return_5d"))


def momentum(spark, d):
    df = features.add_momentum(_bars(spark, d), **_by_symbol(spark, d))
    return rounded(df.drop("open", "high", "low", "volume", "openint", "type"))


def _with_returns(spark, d):
    return features.add_returns(
        _bars(spark, d).select("symbol", "date", "close"), **_by_symbol(spark, d)
    )


def volatility(spark, d):
    df = features.add_volatility(_with_returns(spark, d), **_by_symbol(spark, d))
    return rounded(df.drop("close", "return_5d"))


def zscore(spark, d):
    df = features.add_zscores(_bars(spark, d), **_by_symbol(spark, d))
    return rounded(df.drop("open", "high", "low", "volume", "openint", "type"))


def market_regime(spark, d):
    df = regime.add_market_regime(_with_returns(spark, d), **_by_symbol(spark, d))
    return rounded(df.select("symbol", "date", "market_vol_regime"))


def market_regime_symbol(spark, d):
    df = regime.add_market_regime(
        _with_returns(spark, d), scope="symbol", **_by_symbol(spark, d)
    )
    return rounded(df.select("symbol", "date", "market_vol_regime"))


def _features(spark, d, **options):
    return plan.feature_table(_bars(spark, d), **options, **_by_symbol(spark, d))


def alpha_combos(spark, d):
    df = _features(spark, d, drop_missing=False)
    return rounded(
        df.select("symbol", "date", "momentum_vol_adj", "reversion_strength", "combo_momentum")
    )


def targets(spark, d):
    df = features.add_targets(_bars(spark, d), **_by_symbol(spark, d))
    return rounded(df.select("symbol", "date", "target_1", "target_3", "target_5"))


def recent_rows(spark, d):
    return sampling.recent_rows(_bars(spark, d), 0.3).select("symbol", "date", "close")


def recent_dates(spark, d):
    return sampling.recent_dates(_bars(spark, d), 0.3).select("symbol", "date", "close")


def feature_table(spark, d):
    return rounded(_features(spark, d))


def feature_table_recent(spark, d):
    return rounded(_features(spark, d, date_frac=0.5, scope="symbol", by_rows=False))


# Cross-section and training set


def cs_zscore(spark, d):
    df = _with_returns(spark, d)
    return rounded(crosssection.cross_section_zscore(df, ["close", "return_1d", "return_5d"]))


def rank_pct(spark, d):
    # Bars per day and symbol repeat, so many ranks are shared.
    df = _bars(spark, d).select("symbol", "date", "openint")
    return rounded(crosssection.add_rank_pct(df, "openint", **_by_date(spark, d)))


def time_decay(spark, d):
    df = _bars(spark, d).select("symbol", "date")
    return rounded(crosssection.add_time_decay(df))


def target_smooth(spark, d):
    df = features.add_targets(_bars(spark, d), **_by_symbol(spark, d))
    df = df.select("symbol", "date", "target_5")
    return rounded(crosssection.add_smooth_target(df, **_by_symbol(spark, d)))


def target_standardised(spark, d):
    return rounded(crosssection.standardise(fx.scored_bars(spark, d), "target"))


def min_history(spark, d):
    return sampling.min_history(_bars(spark, d), 530).select("symbol", "date", "close")


def sample_symbols(spark, d):
    return sampling.sample_symbols(_bars(spark, d), 0.3).select("symbol", "date", "close")


def sample_rows(spark, d):
    return sampling.sample_rows(_bars(spark, d), 5000).select("symbol", "date", "close")


def train_test_split(spark, d):
    return sampling.split_flag(_bars(spark, d)).select("symbol", "date", "is_test")


def deciles(spark, d):
    df = crosssection.add_deciles(fx.predictions(spark, d), **_by_date(spark, d))
    return df.select("date", "symbol", "decile")


# Portfolio


def _portfolio(spark, d, calendar="day"):
    return portfolio.add_portfolio(
        fx.predictions(spark, d, calendar), LONG_PCT, **_by_date(spark, d, calendar)
    )


def _traded(spark, d):
    """The portfolio without positions on the 13th of a month, at a hundredth of the
    returns (the prices of the tables are random, a full position would lose everything)."""
    weight = F.when(F.dayofmonth("date") == 13, 0.0).otherwise(F.col("weight"))
    return _portfolio(spark, d).withColumns({"weight": weight, "target": F.col("target") / 100})


def portfolio_weights(spark, d):
    return rounded(_portfolio(spark, d))


def daily_pnl(spark, d):
    return rounded(portfolio.daily_pnl(_traded(spark, d)))


def turnover(spark, d):
    df = portfolio.daily_turnover(_traded(spark, d))
    return rounded(df.select("date", "day_idx", "turnover"))


def daily_net_return(spark, d):
    return rounded(portfolio.daily_returns(_traded(spark, d)).drop("equity"))


def equity_curve(spark, d):
    return significant(portfolio.daily_returns(_traded(spark, d)).select("date", "equity"))


def drawdown(spark, d):
    df = portfolio.add_drawdown(portfolio.daily_returns(_traded(spark, d)))
    return rounded(df.select("date", "drawdown"))


def performance_summary(spark, d):
    return significant(portfolio.performance(_traded(spark, d)))


def _signed(spark, d):
    """Predictions held at their own score, so both sides occur."""
    return fx.predictions(spark, d).withColumn("weight", F.col("prediction") / 100)


def long_short(spark, d):
    return rounded(portfolio.long_short(_signed(spark, d)))


def long_short_summary(spark, d):
    return significant(portfolio.long_short_summary(_signed(spark, d)))


def backtest_checks(spark, d):
    return rounded(portfolio.backtest_checks(_traded(spark, d)))


def ic_flip(spark, d):
    return rounded(portfolio.flip_on_negative_ic(fx.predictions(spark, d)))


def ic_flip_reversed(spark, d):
    """The same for reversed predictions: of the two, one is turned round."""
    reverse = fx.predictions(spark, d).withColumn("prediction", -F.col("prediction"))
    return rounded(portfolio.flip_on_negative_ic(reverse))


# Signals


def _signals(spark, d, calendar="day"):
    return signals.add_signals(
        fx.predictions(spark, d, calendar), LONG_PCT, SHORT_PCT, **_by_date(spark, d, calendar)
    )


# On the last day two names trade, in the last month all of them.
def _monthly_signals(spark, d):
    return _signals(spark, d, "month")


def signal_table(spark, d):
    return rounded(_signals(spark, d))


def latest_signals(spark, d):
    return rounded(signals.latest_signals(_monthly_signals(spark, d)))


def latest_trades(spark, d):
    return rounded(signals.latest_trades(_monthly_signals(spark, d)))


def top_signals(spark, d):
    return rounded(signals.top_signals(_monthly_signals(spark, d)))


def signal_summary(spark, d):
    return rounded(signals.signal_summary(_monthly_signals(spark, d)))


def top_stocks(spark, d):
    return rounded(signals.top_stocks(_portfolio(spark, d, "month")))


# Quality of features and predictions


def missing_report(spark, d):
    return quality.missing_report(_features(spark, d, drop_missing=False))


def nan_inf_check(spark, d):
    # More columns than the ten that are listed.
    raw = fx.raw_bars(spark, d).withColumns(
        {
            "Range": F.col("High") - F.col("Low"),
            "Gain": F.col("Close") - F.col("Open"),
            "Name": F.upper("symbol"),
        }
    )
    return quality.nan_inf_check(raw)


def symbol_health(spark, d):
    return quality.symbol_health(_bars(spark, d))


def target_analysis(spark, d):
    df = features.add_targets(_bars(spark, d), **_by_symbol(spark, d))
    return significant(quality.target_analysis(df))


def feature_quality(spark, d):
    return significant(quality.feature_quality(_features(spark, d)))


def leakage_check(spark, d):
    return rounded(quality.leakage_check(_features(spark, d)))


def dispersion(spark, d):
    df = _with_returns(spark, d)
    return significant(quality.dispersion(df, ["close", "return_1d", "return_5d"]))


def daily_ic(spark, d):
    return rounded(quality.daily_ic(fx.predictions(spark, d)))


def daily_rank_ic(spark, d):
    return rounded(quality.daily_rank_ic(fx.predictions(spark, d), **_by_date(spark, d)))


def ic_summary(spark, d):
    return rounded(quality.ic_summary(fx.predictions(spark, d), **_by_date(spark, d)))


def decile_analysis(spark, d):
    return rounded(quality.decile_analysis(fx.predictions(spark, d), **_by_date(spark, d)))


def decile_spread(spark, d):
    return rounded(quality.decile_spread(fx.predictions(spark, d), **_by_date(spark, d)))


def prediction_diagnostics(spark, d):
    return rounded(quality.prediction_diagnostics(fx.predictions(spark, d)))


def directional_accuracy(spark, d):
    return rounded(quality.directional_accuracy(fx.predictions(spark, d)))


def validation_warnings(spark, d):
    return rounded(quality.validation_warnings(_signed(spark, d)))


# Ingest and cleaning


def extract_symbol_names(spark, d):
    df = fx.file_names(spark, d)
    return df.select("s_suppkey", "file_name", extract_symbol("file_name").alias("symbol"))


def extract_ticker_names(spark, d):
    df = fx.file_names(spark, d)
    return df.select("s_suppkey", "file_name", extract_ticker("file_name").alias("ticker"))


def ticker_lookup(spark, d):
    # The ticker asked for is the first one by name.
    names = fx.manifest(spark, d).withColumn("symbol", extract_symbol("file_name"))
    wanted = names.agg(F.lower(F.min("symbol")).alias("t")).scalar()
    return names.where(ticker_equals("symbol", F.concat(F.lit(" "), wanted)))


def universe_symbols(spark, d):
    return universe.symbol_set(fx.symbol_list(spark, d))


def _listed(spark, d):
    return fx.manifest(spark, d), universe.symbol_set(fx.symbol_list(spark, d))


def universe_filter(spark, d):
    return universe.matched_files(*_listed(spark, d))


def universe_empty(spark, d):
    return universe.empty_files(*_listed(spark, d))


def universe_missing(spark, d):
    return universe.missing_symbols(*_listed(spark, d))


def universe_summary(spark, d):
    return universe.filter_summary(*_listed(spark, d))


def universe_bars(spark, d):
    listed = fx.table(spark, d, "supplier").where(F.col("s_suppkey") % fx.LISTED_EVERY == 0)
    symbols = universe.symbol_set(listed.select(fx.symbol_of("s_suppkey").alias("Symbol")))
    return universe.universe_bars(_bars(spark, d), symbols).select("symbol", "date", "close")


def merge_tables(spark, d):
    b = _bars(spark, d)
    stocks = b.where(F.col("type") == 0).select("date", "close", "volume", "symbol")
    etfs = b.where(F.col("type") == 1).select("symbol", "open", "close", "date")
    return merge_sources(stocks, etfs)


def clean_bars(spark, d):
    return cleaning.clean_bars(fx.raw_bars(spark, d))


def cleaning_report(spark, d):
    return cleaning.cleaning_report(fx.raw_bars(spark, d))


def typed_bars(spark, d):
    return cleaning.typed_bars(cleaning.clean_bars(fx.raw_bars(spark, d)))


def precheck(spark, d):
    return cleaning.precheck(fx.raw_bars(spark, d))


def guardrail(spark, d):
    return cleaning.guardrail(fx.raw_bars(spark, d).drop("OpenInt"))


# Model


def training_table(spark, d):
    return rounded(training.training_table(_features(spark, d)))


def _millionths(df):
    """`rounded(df)` as a stage: its doubles are written as whole millionths, which pack better."""
    doubles = set(_doubles(df))
    whole = [F.floor(F.col(c) * 1e6 + 0.5).alias(c) if c in doubles else F.col(c) for c in df.columns]
    stage = staged(df.select(*whole))
    return stage.select(*[(F.col(c) / F.lit(1e6)).alias(c) if c in doubles else F.col(c) for c in df.columns])


def _boosted(spark, d):
    """Rounded training rows, and the nodes of a small model on all of them."""
    table = training.training_table(_features(spark, d))
    # The model reads neither.
    table = _millionths(table.drop("target_raw", "time_rank"))
    rows, columns = boosting.training_rows(table, None)
    model = boosting.fit(
        rows, columns, BOOSTED_TREES, BOOSTED_STEP, patience=None, max_leaves=BOOSTED_LEAVES,
        row_share=1, column_share=1,
    )
    return table, model.table(spark)


def boosted_splits(spark, d):
    _, nodes = _boosted(spark, d)
    splits = nodes.where("feature IS NOT NULL")
    return splits.select(
        F.col("tree").cast("bigint"),
        "feature",
        (F.floor(F.col("threshold") * 1e6 + 0.5) / F.lit(1e6)).alias("threshold"),
        F.format_string("%.8e", "gain").cast("double").alias("gain"),
        "rows",
    )


def boosted_scores(spark, d):
    table, nodes = _boosted(spark, d)
    return rounded(boosting.score(table, nodes).select("date", "symbol", "is_test", "prediction"))


# Models of this application's runs by folder: both queries report on one training.
_MODELS = {}


def _trained(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        _MODELS[key] = boosting.train_predict(_features(spark, d), long_pct=LONG_PCT)
    return _MODELS[key]


def train_predict(spark, d):
    return _trained(spark, d).predictions


def train_predict_checks(spark, d):
    """What holds for any model, per test date."""
    p = _trained(spark, d).predictions
    total, longs = F.sum("weight"), F.count(F.when(F.col("weight") > 0, 1))
    return p.groupBy("date").agg(
        F.count(F.lit(1)).alias("names"),
        F.min(F.abs("prediction") < float("inf")).alias("finite"),
        ((F.abs(total - 1) < 1e-9) | (F.abs(total) < 1e-9)).alias("weights_sum"),
        (longs <= F.floor(F.count(F.lit(1)) * LONG_PCT) + 1).alias("few_longs"),
    )


QUERIES = {
    "returns": returns,
    "momentum": momentum,
    "volatility": volatility,
    "zscore": zscore,
    "market_regime": market_regime,
    "market_regime_symbol": market_regime_symbol,
    "alpha_combos": alpha_combos,
    "targets": targets,
    "recent_rows": recent_rows,
    "recent_dates": recent_dates,
    "feature_table": feature_table,
    "feature_table_recent": feature_table_recent,
    "cs_zscore": cs_zscore,
    "rank_pct": rank_pct,
    "time_decay": time_decay,
    "target_smooth": target_smooth,
    "target_standardised": target_standardised,
    "min_history": min_history,
    "sample_symbols": sample_symbols,
    "sample_rows": sample_rows,
    "train_test_split": train_test_split,
    "deciles": deciles,
    "portfolio_weights": portfolio_weights,
    "daily_pnl": daily_pnl,
    "turnover": turnover,
    "daily_net_return": daily_net_return,
    "equity_curve": equity_curve,
    "drawdown": drawdown,
    "performance_summary": performance_summary,
    "long_short": long_short,
    "long_short_summary": long_short_summary,
    "backtest_checks": backtest_checks,
    "ic_flip": ic_flip,
    "ic_flip_reversed": ic_flip_reversed,
    "signals": signal_table,
    "latest_signals": latest_signals,
    "latest_trades": latest_trades,
    "top_signals": top_signals,
    "signal_summary": signal_summary,
    "top_stocks": top_stocks,
    "missing_report": missing_report,
    "nan_inf_check": nan_inf_check,
    "symbol_health": symbol_health,
    "target_analysis": target_analysis,
    "feature_quality": feature_quality,
    "leakage_check": leakage_check,
    "dispersion": dispersion,
    "daily_ic": daily_ic,
    "daily_rank_ic": daily_rank_ic,
    "ic_summary": ic_summary,
    "decile_analysis": decile_analysis,
    "decile_spread": decile_spread,
    "prediction_diagnostics": prediction_diagnostics,
    "directional_accuracy": directional_accuracy,
    "validation_warnings": validation_warnings,
    "extract_symbol": extract_symbol_names,
    "extract_ticker": extract_ticker_names,
    "ticker_lookup": ticker_lookup,
    "universe_symbols": universe_symbols,
    "universe_filter": universe_filter,
    "universe_empty": universe_empty,
    "universe_missing": universe_missing,
    "universe_summary": universe_summary,
    "universe_bars": universe_bars,
    "merge_sources": merge_tables,
    "clean_bars": clean_bars,
    "cleaning_report": cleaning_report,
    "typed_bars": typed_bars,
    "precheck": precheck,
    "guardrail": guardrail,
    "training_table": training_table,
    "boosted_splits": boosted_splits,
    "boosted_scores": boosted_scores,
    "train_predict": train_predict,
    "train_predict_checks": train_predict_checks,
}
