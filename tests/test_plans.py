"""The plans that matter at scale."""

import pytest

from tickerloom import fixtures as fx
from tickerloom.operators import crosssection, portfolio
from tickerloom.plans.feature_table import feature_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bars")
    fx.bars(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def lines_with(df, *texts):
    return [line for line in plan(df) if all(t in line for t in texts)]


def test_features_share_one_exchange_and_one_sort(bars):
    df = feature_table(bars, scope="symbol")
    # One for the daily market level, one for all features.
    assert len(lines_with(df, "Exchange hashpartitioning(symbol")) == 2
    assert len(lines_with(df, "Sort [symbol")) == 2
    assert not lines_with(df, "Python")
    assert not lines_with(df, "CartesianProduct") and not lines_with(df, "NestedLoop")


def test_level_pass_reads_three_columns(bars):
    scans = lines_with(feature_table(bars, scope="symbol"), "FileScan")
    assert any("ReadSchema: struct<symbol:string,date:date,close:double>" in s for s in scans)


def test_windows_without_partition_only_over_dates(bars):
    df = feature_table(bars)
    single = lines_with(df, "Exchange SinglePartition")
    # Daily levels (planned twice, run once) and the carried levels per symbol.
    assert len(single) == 3


def test_cross_section_does_not_move_rows(bars):
    df = crosssection.cross_section_zscore(bars, ["close", "open"])
    assert len(lines_with(df, "BroadcastHashJoin")) == 1
    assert len(lines_with(df, "Exchange hashpartitioning")) == 1
    assert lines_with(df, "partial_avg")


def test_turnover_has_no_row_join(spark, bars):
    held = bars.selectExpr("date", "symbol", "1D AS weight", "0.01D AS target")
    df = portfolio.daily_turnover(held)
    assert not lines_with(df, "FullOuter")
    assert lines_with(df, "HashAggregate(keys=[day_idx", "symbol", "partial_sum")
