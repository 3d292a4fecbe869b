"""Edge cases with results worked out by hand or by a plain loop."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import crosssection, features, portfolio, quality, sampling, signals
from tickerloom.operators.lineage import checked_broadcast
from tickerloom.plans import daily_run


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_returns_and_targets_of_a_short_symbol(spark):
    closes = [10.0, 11.0, 0.0, 5.0]
    df = frame(spark, [("A", day(i), c) for i, c in enumerate(closes)],
               "symbol string, date date, close double")
    rows = features.add_targets(features.add_returns(df)).orderBy("date").collect()
    assert [r.return_1d for r in rows] == [None, pytest.approx(0.1), -1.0, None]
    assert [r.return_5d for r in rows] == [None] * 4
    assert [r.target_1 for r in rows] == [pytest.approx(0.1), -1.0, None, None]
    assert [r.target_3 for r in rows] == [-0.5, None, None, None]


def test_rolling_against_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"symbol": "A", "date": [day(i) for i in range(200)],
                        "close": 1e6 + rng.normal(0, 1e-2, 200)})
    pdf.loc[120, "close"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("close", F.when(~F.isnan("close"), F.col("close")))
    ours = features.add_zscores(features.add_momentum(df)).toPandas().sort_values("date")
    for n in (5, 10, 20, 50):
        mean, std = pdf["close"].rolling(n).mean(), pdf["close"].rolling(n).std()
        np.testing.assert_allclose(ours[f"ma_ratio_{n}"], pdf["close"] / (mean + 1e-9), rtol=1e-12)
        z = (pdf["close"] - mean) / (std + 1e-9)
        np.testing.assert_allclose(ours[f"zscore_{n}"], z, rtol=1e-4, atol=1e-6)


def test_drop_incomplete(spark):
    df = frame(spark, [("A", 1.0), ("B", math.inf), ("C", math.nan), ("D", None), (None, 1.0)],
               "s string, x double")
    assert [r.s for r in features.drop_incomplete(df).collect()] == ["A"]


def test_zscore_of_one_row_and_equal_values(spark):
    df = frame(spark, [(day(0), 5.0), (day(1), 2.0), (day(1), 2.0)], "date date, x double")
    rows = crosssection.cross_section_zscore(df, ["x"]).orderBy("date").collect()
    assert [r.x for r in rows] == [None, 0.0, 0.0]


def test_short_wins_over_buy(spark):
    df = frame(spark, [(day(0), "A", 1.0), (day(0), "B", 2.0), (day(1), "C", 1.0)],
               "date date, symbol string, prediction double")
    rows = {r.symbol: r for r in signals.add_signals(df, 0.5, 0.5).collect()}
    assert (rows["A"].signal, rows["B"].signal, rows["C"].signal) == ("SHORT", "BUY", "HOLD")
    assert rows["C"].rank_pct is None
    overlap = {r.symbol: r.signal for r in signals.add_signals(df, 1.0, 1.0).collect()}
    assert (overlap["A"], overlap["B"]) == ("SHORT", "SHORT")
    assert 0.99 < rows["A"].confidence <= 1


def test_top_signal_lines(spark):
    df = frame(spark, [(day(0), f"S{i}", float(i)) for i in range(10)],
               "date date, symbol string, prediction double")
    table = signals.add_signals(df, 0.2, 0.1)
    top = signals.top_signals(table).orderBy("signal", "position").collect()
    assert [(r.signal, r.position, r.symbol) for r in top] == [
        ("BUY", 1, "S9"), ("BUY", 2, "S8"), ("BUY", 3, "S7"), ("SHORT", 1, "S0")]
    assert top[0].line == "S9         | conf=1.000 | hold=N/A"
    held = signals.top_signals(signals.latest_signals(table)).where("symbol = 'S9'").first()
    assert held.line.endswith("hold=5")


def test_portfolio_weights(spark):
    rows = [(day(0), f"S{i:02d}", float(i)) for i in range(50)]
    rows += [(day(1), f"S{i:02d}", 1.0) for i in range(50)]
    df = frame(spark, rows, "date date, symbol string, prediction double")
    table = portfolio.add_portfolio(df, 0.1)
    sums = {r.date: r.s for r in table.groupBy("date").agg(F.sum("weight").alias("s")).collect()}
    assert sums[day(0)] == pytest.approx(1.0)
    assert sums[day(1)] == 0.0
    chosen = table.where("date = '2020-01-01' and weight > 0").collect()
    assert {r.symbol for r in chosen} == {f"S{i}" for i in range(44, 50)}
    assert {r["rank"] for r in table.collect()} == set(range(1, 51))


def loop_backtest(pdf, cost):
    """Day by day, as a ledger would do it."""
    previous, equity, out = {}, 1.0, []
    for date, g in pdf.groupby("date"):
        g = g.dropna(subset=["weight", "target"])
        gross = g["weight"].abs().sum()
        if len(g) == 0 or gross < 1e-12:
            continue
        now = dict(zip(g["symbol"], g["weight"] / gross))
        pnl = sum(now[s] * t for s, t in zip(g["symbol"], g["target"]))
        turnover = sum(abs(now.get(s, 0) - previous.get(s, 0)) for s in {*now, *previous})
        net = max(pnl - cost * turnover, -0.99)
        equity *= 1 + net
        out.append((date, pnl, turnover, net, equity))
        previous = now
    return out


def test_backtest_against_loop(spark):
    rng = np.random.default_rng(4)
    rows = []
    for d in range(40):
        for s in rng.choice(30, 12, replace=False):
            weight = 0.0 if d % 7 == 3 else float(rng.normal())
            target = -5.0 if d == 20 else float(rng.normal(0, 0.05))
            rows.append((day(d), f"S{s}", None if s == 5 else weight, target))
    pdf = pd.DataFrame(rows, columns=["date", "symbol", "weight", "target"])
    df = frame(spark, rows, "date date, symbol string, weight double, target double")
    ours = portfolio.daily_returns(df, 0.001).orderBy("date").collect()
    expected = loop_backtest(pdf, 0.001)
    assert [r.date for r in ours] == [e[0] for e in expected]
    for i, name in enumerate(("pnl", "turnover", "net_return", "equity"), 1):
        np.testing.assert_allclose([r[name] for r in ours], [e[i] for e in expected], rtol=1e-9)
    result = portfolio.performance(df, 0.001).first()
    assert result.total_return == pytest.approx(expected[-1][4] - 1)
    assert result.traded_days == len(expected)
    assert result.skipped_days == 40 - len(expected)
    curve = pd.Series([e[4] for e in expected])
    assert result.max_drawdown == pytest.approx(((curve - curve.cummax()) / curve.cummax()).min())


def test_nothing_traded(spark):
    df = frame(spark, [(day(0), "A", 0.0, 0.1)],
               "date date, symbol string, weight double, target double")
    assert portfolio.performance(df).first().asDict() == {
        "total_return": 0.0, "sharpe": 0.0, "max_drawdown": 0.0, "traded_days": 0,
        "skipped_days": 1}
    assert portfolio.backtest_checks(df).first().short_only


def test_flip(spark):
    rows = [(day(d), f"S{i}", float(i), -float(i)) for d in range(3) for i in range(4)]
    df = frame(spark, rows, "date date, symbol string, prediction double, target double")
    flipped = portfolio.flip_on_negative_ic(df).where("symbol = 'S3'").collect()
    assert {r.prediction for r in flipped} == {-3.0}
    kept = df.withColumn("target", -F.col("target"))
    assert {r.prediction for r in portfolio.flip_on_negative_ic(kept).collect()} == {0, 1, 2, 3}
    # A flat prediction has no correlation and is left alone.
    flat = df.withColumn("prediction", F.lit(1.0))
    assert {r.prediction for r in portfolio.flip_on_negative_ic(flat).collect()} == {1.0}


def test_ic_needs_complete_dates(spark):
    rows = [(day(0), "A", 1.0, 1.0), (day(0), "B", 2.0, 2.0), (day(0), "C", 3.0, 2.5),
            (day(1), "A", 1.0, 1.0), (day(1), "B", 2.0, None), (day(1), "C", 3.0, 1.0),
            (day(2), "A", 1.0, 1.0), (day(3), "A", 1.0, 1.0), (day(3), "B", 1.0, 2.0)]
    df = frame(spark, rows, "date date, symbol string, prediction double, target double")
    ic = {r.date: r.ic for r in quality.daily_ic(df).collect()}
    assert ic == {day(0): pytest.approx(0.981981, abs=1e-6), day(1): None, day(3): None}
    rank = {r.date: r.rank_ic for r in quality.daily_rank_ic(df).collect()}
    assert rank == {day(0): pytest.approx(1.0), day(1): None, day(3): None}


def test_deciles_against_qcut(spark):
    rng = np.random.default_rng(9)
    frames = []
    for d in range(30):
        n = int(rng.integers(2, 60))
        values = rng.normal(0, 1, n) if d % 3 else rng.integers(0, 4, n).astype(float)
        frames.append(pd.DataFrame({"date": day(d), "symbol": [f"S{i}" for i in range(n)],
                                    "prediction": values}))
    pdf = pd.concat(frames)
    ours = crosssection.add_deciles(spark.createDataFrame(pdf)).toPandas()
    for _, g in ours.groupby("date"):
        if g["prediction"].nunique() > 1:
            expected = pd.qcut(g["prediction"], 10, labels=False, duplicates="drop")
            assert (expected == g["decile"]).all()
        else:
            assert g["decile"].isna().all()


def test_samples(spark):
    df = frame(spark, [(f"S{i % 50}", day(i // 50)) for i in range(1000)],
               "symbol string, date date")
    assert sampling.sample_rows(df, 137).count() == 137
    assert sampling.sample_rows(df, 0).count() == 0
    assert sampling.sample_rows(df, 5000).count() == 1000
    assert sampling.sample_symbols(df, 0.31).select("symbol").distinct().count() == 15
    assert sampling.sample_symbols(df, None).count() == 1000
    again = sampling.sample_rows(df.repartition(7), 137)
    assert again.exceptAll(sampling.sample_rows(df, 137)).count() == 0
    assert sampling.min_history(df, 21).count() == 0
    assert sampling.min_history(df, 20).count() == 1000


def test_recent_and_split(spark):
    df = frame(spark, [(day(i),) for i in range(10)], "date date")
    assert sampling.recent_rows(df, 0.3).count() == 3
    assert sampling.recent_dates(df, 0.3).count() == 3
    assert sampling.recent_rows(df, 1.0).count() == 10
    with pytest.raises(ValueError):
        sampling.recent_dates(df, 0)
    train, test = sampling.train_test_split(df)
    assert (train.count(), test.count()) == (8, 2)
    assert sampling.latest_date(df).collect()[0].date == day(9)


def test_cutoff_reaches_the_scan(spark, tmp_path):
    df = frame(spark, [(day(i), float(i), "x") for i in range(10)], "date date, close double, s string")
    df.write.parquet(str(tmp_path / "bars"))
    recent = sampling.recent_rows(spark.read.parquet(str(tmp_path / "bars")), 0.5).select("close")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("ReadSchema: struct<date:date,close:double>" in scan for scan in scans)
    assert all("IsNotNull(date)" in scan for scan in scans)


def test_broadcast_only_if_small(spark):
    ids = spark.range(100)
    big = spark.range(1000)
    hinted = big.join(checked_broadcast(ids, 100), "id")
    assert "strategy=broadcast" in hinted._jdf.queryExecution().logical().toString()
    plain = big.join(checked_broadcast(ids, 99), "id")
    assert "strategy=broadcast" not in plain._jdf.queryExecution().logical().toString()


def test_research_run(spark, tmp_path):
    rng = np.random.default_rng(8)
    frames = [
        pd.DataFrame({"symbol": f"S{i}", "date": [day(d) for d in range(130)],
                      "close": 50 * np.exp(rng.normal(0, 0.02, 130).cumsum()),
                      "volume": rng.integers(1, 9, 130)})
        for i in range(12)
    ]
    spark.createDataFrame(pd.concat(frames)).write.parquet(str(tmp_path / "bars"))
    paths = daily_run.research(spark, str(tmp_path / "bars"), str(tmp_path / "out"),
                               long_pct=0.2, short_pct=0.2, max_iter=2, max_depth=2)
    predictions = spark.read.parquet(paths["predictions"])
    assert predictions.columns == ["date", "symbol", "prediction", "target", "rank", "rank_pct",
                                   "weight"]
    sums = predictions.groupBy("date").agg(F.sum("weight").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) or r.s == 0 for r in sums)
    table = spark.read.parquet(paths["signals"])
    assert {r.signal for r in table.select("signal").distinct().collect()} <= {"BUY", "SHORT", "HOLD"}
    checks = daily_run.validate(predictions)
    assert checks["ic"].first().mean_ic is not None
    assert daily_run.report(table)["summary"].first().total > 0
    assert spark.read.csv(paths["equity_curve"], header=True).columns[0] == "date"
