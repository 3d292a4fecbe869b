"""Groups above `rows_per_task` are cut into chunks; results must not change."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import crosssection, features, portfolio, regime, signals
from tickerloom.operators.ordered import (
    cut_points,
    over_groups,
    quantiles,
    with_average_rank,
    with_neighbours,
    with_position,
)
from tickerloom.plans.feature_table import feature_table

SMALL = dict(rows_per_task=300)


@pytest.fixture(scope="module")
def bars(spark):
    """One symbol with two thirds of all rows, 40 symbols of 1 to 120 rows."""
    rng = np.random.default_rng(1)
    frames = []
    for i in range(41):
        n = 3000 if i == 7 else int(rng.integers(1, 120))
        frames.append(
            pd.DataFrame(
                {
                    "symbol": f"S{i:02d}",
                    "date": pd.date_range("2010-01-01", periods=n + 5)[5 * (i % 2) :][:n].date,
                    "close": 100 + rng.normal(0, 1, n).cumsum() * 0.1,
                    "volume": rng.integers(1, 100, n),
                }
            )
        )
    return spark.createDataFrame(pd.concat(frames).sample(frac=1, random_state=3)).repartition(5)


@pytest.fixture(scope="module")
def scores(spark):
    """One date with most rows, a third of them with an equal prediction."""
    rng = np.random.default_rng(2)
    frames = []
    for day in range(12):
        n = 4000 if day == 4 else int(rng.integers(1, 60))
        prediction = rng.normal(0, 1, n).round(2)
        prediction[: n // 3] = 0.25
        frames.append(
            pd.DataFrame(
                {
                    "symbol": [f"S{i:05d}" for i in rng.permutation(n)],
                    "date": pd.Timestamp("2020-01-01").date() + pd.Timedelta(days=day),
                    "prediction": prediction,
                    "target": rng.normal(0, 0.02, n),
                }
            )
        )
    return spark.createDataFrame(pd.concat(frames).sample(frac=1, random_state=3)).repartition(5)


def same(a, b, keys=("symbol", "date")):
    left = a.toPandas().sort_values(list(keys)).reset_index(drop=True)
    right = b.toPandas().sort_values(list(keys)).reset_index(drop=True)[list(left.columns)]
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=1e-9, atol=1e-12)
    assert len(left)


def test_chunks_are_many_and_large_enough(bars):
    points = cut_points(bars, ["symbol"], ["date"], **SMALL)
    assert [r.symbol for r in points.collect()] == ["S07"]
    rows = with_neighbours(bars, ["symbol"], ["date"], 50, 5, points=points)
    sizes = rows.where("symbol = 'S07' and not _halo").groupBy("_chunk").count().collect()
    assert len(sizes) >= 5
    assert min(r["count"] for r in sizes) >= 64
    assert rows.where("not _halo").count() == bars.count()


def test_no_chunks_without_large_group(bars):
    assert cut_points(bars, ["symbol"], ["date"]) is None


def test_features(bars):
    for add in (features.add_returns, features.add_momentum, features.add_zscores):
        same(add(bars, **SMALL), add(bars))
    same(features.add_targets(bars, **SMALL), features.add_targets(bars))


@pytest.mark.parametrize("scope", ["row_order", "symbol"])
def test_feature_table(bars, scope):
    small = feature_table(bars, scope=scope, drop_missing=False, symbols_per_task=130, **SMALL)
    same(small, feature_table(bars, scope=scope, drop_missing=False))


def test_regime_matches_table_wide_window(bars):
    returned = features.add_returns(bars)
    for options in ({}, SMALL, dict(symbols_per_task=130, **SMALL), dict(symbols_per_task=1)):
        ours = (
            regime.add_market_regime(returned, **options)
            .toPandas()
            .sort_values(["symbol", "date"])
            .reset_index(drop=True)
        )
        daily = ours.groupby("date")["return_1d"].std().rolling(20, min_periods=5).mean()
        level = ours["date"].map(daily)
        expected = level / (level.rolling(50).mean() + 1e-9)
        assert expected.notna().sum() > 1000
        np.testing.assert_allclose(ours["market_vol_regime"], expected, rtol=1e-9)


def test_many_symbols_carry_across_chunks(spark):
    """Symbols of one to three rows: the carried levels come from dozens of symbols."""
    rng = np.random.default_rng(5)
    rows = [
        (f"S{i:04d}", pd.Timestamp("2020-01-01") + pd.Timedelta(days=int(day)), rng.normal())
        for i in range(900)
        for day in rng.choice(40, size=rng.integers(1, 4), replace=False)
    ]
    pdf = pd.DataFrame(rows, columns=["symbol", "date", "return_1d"])
    pdf["date"] = pdf["date"].dt.date
    df = spark.createDataFrame(pdf)
    few = regime.add_market_regime(df)
    many = regime.add_market_regime(df, symbols_per_task=130)
    same(many, few)
    ours = few.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    daily = ours.groupby("date")["return_1d"].std().rolling(20, min_periods=5).mean()
    level = ours["date"].map(daily)
    expected = level / (level.rolling(50).mean() + 1e-9)
    np.testing.assert_allclose(ours["market_vol_regime"], expected, rtol=1e-9)


def test_position(scores):
    order = ["prediction", "symbol"]
    ours = with_position(scores, ["date"], order, **SMALL).toPandas()
    expected = ours.sort_values(order).groupby("date").cumcount() + 1
    assert (expected.reindex(ours.index) == ours["_pos"]).all()


def test_average_rank_with_a_run_over_several_chunks(scores):
    ours = with_average_rank(scores, ["date"], "prediction", ["symbol"], **SMALL).toPandas()
    expected = ours.groupby("date")["prediction"].rank()
    np.testing.assert_allclose(ours["_rank"], expected)
    assert len(ours) == scores.count()


def test_rank_pct_with_missing_values(scores):
    holes = scores.withColumn(
        "prediction", F.when(F.substring("symbol", 6, 1) != "3", F.col("prediction"))
    )
    for options in ({}, SMALL):
        ours = crosssection.add_rank_pct(holes, "prediction", **options).toPandas()
        expected = ours.groupby("date")["prediction"].rank(pct=True)
        np.testing.assert_allclose(ours["rank_pct"], expected)


def test_quantiles(scores):
    probabilities = [0, 0.1, 0.25, 0.5, 0.9, 1]
    for options in ({}, SMALL):
        ours = quantiles(
            scores,
            ["date"],
            "prediction",
            probabilities,
            ["symbol"],
            lambda rows, counts: rows.join(counts, "date"),
            **options,
        ).collect()
        pdf = scores.toPandas()
        for row in ours:
            expected = pdf[pdf["date"] == row["date"]]["prediction"].quantile(probabilities)
            np.testing.assert_allclose(row["_quantiles"], expected, rtol=1e-12)


def test_cross_section_operators(scores):
    same(
        crosssection.add_deciles(scores, **SMALL), crosssection.add_deciles(scores)
    )
    same(
        portfolio.add_portfolio(scores, 0.1, **SMALL), portfolio.add_portfolio(scores, 0.1)
    )
    same(
        signals.add_signals(scores, 0.1, 0.1, **SMALL), signals.add_signals(scores, 0.1, 0.1)
    )


def test_frames_over_any_group(scores):
    def add(rows, w):
        return rows.withColumn("s", F.sum("target").over(w.rowsBetween(-9, 2)))

    args = (scores, ["date"], ["symbol"], add, 9, 2)
    same(over_groups(*args, **SMALL), over_groups(*args))
