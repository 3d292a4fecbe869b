"""The end-to-end runs. Every stage reads the table the stage before it wrote."""

import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import portfolio, quality, signals
from ..operators.cleaning import counted_clean_bars, typed_bars
from ..operators.universe import (
    EMPTY_THRESHOLD,
    empty_files,
    filter_summary,
    matched_files,
    missing_symbols,
    symbol_set,
    universe_bars,
)
from ..sources.stages import scratch, staged
from ..sources.tables import read_table, write_bars, write_by_date, write_csv
from ..sources.ticker_files import FOLDERS, file_manifest, merge_with_rejects, read_symbols
from .boosting import save_model, train_predict
from .feature_table import feature_table


@dataclass
class Ingested:
    """`counts` are the rows in, out and removed by each step; `rejects` what couldn't be read."""

    bars: DataFrame
    counts: dict
    rejects: DataFrame


def ingest_counted(spark, base, out, kind="both", symbols_path=None, by_year=False, rejects_out=None):
    """Ticker files -> merged, cleaned, typed bars in one table, with counts of the same pass.

    `rejects` is a table at `rejects_out` if that is given, else read from the files when used.
    """
    merged, rejects = merge_with_rejects(spark, base, kind)
    with scratch(spark):
        clean, counts = counted_clean_bars(merged)
        bars = typed_bars(staged(clean, "clean"))
        if symbols_path:
            bars = universe_bars(bars, symbol_set(read_symbols(spark, symbols_path)))
        write_bars(bars, out, by_year)
        if rejects_out:
            write_csv(rejects, rejects_out)
            rejects = spark.read.csv(rejects_out, header=True, schema=rejects.schema, multiLine=True, escape='"')
    return Ingested(read_table(spark, out), counts(), rejects)


def ingest(spark, base, out, kind="both", symbols_path=None, by_year=False):
    """Ticker files -> merged, cleaned, typed bars in one table."""
    return ingest_counted(spark, base, out, kind, symbols_path, by_year).bars


def select_universe(spark, base, symbols_path, out, empty_threshold=EMPTY_THRESHOLD):
    """Symbol list and stock files -> CSV tables below `out`, by name.

    `matched` lists the files in ticker order, `missing` the symbols without a file and
    `summary` the counts. With more empty files than the threshold, `empty` lists them.
    """
    _, folder = FOLDERS["stocks"]
    manifest = file_manifest(spark, posixpath.join(base, folder))
    symbols = symbol_set(read_symbols(spark, symbols_path))
    summary = filter_summary(manifest, symbols, empty_threshold)
    tables = {
        "matched": matched_files(manifest, symbols),
        "missing": missing_symbols(manifest, symbols),
        "summary": summary,
    }
    if summary.first()["mode"] == "skip":
        tables["empty"] = empty_files(manifest)
    paths = {name: posixpath.join(out, name) for name in tables}
    for name, table in tables.items():
        # Lists of files are small; one part keeps their order.
        write_csv(table.coalesce(1), paths[name])
    return paths


def research(spark, bars_path, out, date_frac=1.0, long_pct=0.02, short_pct=0.02, **training):
    """Bars -> features -> model and predictions -> checks, signals and equity curve."""
    paths = {
        name: posixpath.join(out, name)
        for name in ("features", "model", "predictions", "signals", "equity_curve")
    }
    write_bars(feature_table(read_table(spark, bars_path), date_frac), paths["features"])
    with scratch(spark):
        trained = train_predict(read_table(spark, paths["features"]), long_pct=long_pct, **training)
        save_model(trained.nodes, paths["model"])
        write_by_date(trained.predictions, paths["predictions"])
    predictions = read_table(spark, paths["predictions"])
    with scratch(spark):
        write_by_date(signals.add_signals(predictions, long_pct, short_pct), paths["signals"])
        write_csv(portfolio.daily_returns(predictions), paths["equity_curve"])
    return paths


def validate(predictions):
    """The prediction checks by name, each a table."""
    return {
        "defects": quality.nan_inf_check(predictions),
        "ic": quality.ic_summary(predictions),
        "long_short": portfolio.long_short_summary(predictions),
        "deciles": quality.decile_analysis(predictions),
        "decile_spread": quality.decile_spread(predictions),
        "diagnostics": quality.prediction_diagnostics(predictions),
        "accuracy": quality.directional_accuracy(predictions),
        "warnings": quality.validation_warnings(predictions),
        "backtest": portfolio.performance(predictions),
        "backtest_inputs": portfolio.backtest_checks(predictions),
    }


def validate_features(features):
    """The feature checks by name, each a table."""
    return {
        "defects": quality.nan_inf_check(features),
        "targets": quality.target_analysis(features),
        "variance": quality.feature_quality(features),
        "leakage": quality.leakage_check(features),
        "dispersion": quality.dispersion(features),
        "symbols": quality.symbol_health(features),
    }


def report(signal_table):
    """The tables of the signal report by name."""
    return {
        "summary": signals.signal_summary(signal_table),
        "top": signals.top_signals(signal_table),
    }
