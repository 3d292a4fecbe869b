"""Counts of an ingest run from its own write, bucketed tables, and an entry without the other packages."""

import datetime as dt
import importlib
import sys

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import cleaning, crosssection, features
from tickerloom.plans import daily_run
from tickerloom.sources import tables

HEADER = "Date,Open,High,Low,Close,Volume,OpenInt\n"


@pytest.fixture()
def base(tmp_path):
    (tmp_path / "raw" / "Stocks").mkdir(parents=True)
    for k in range(6):
        rows = "".join(f"2020-01-{d:02d},1,2,0.5,1.5,{d},0\n" for d in range(1, 11))
        rows += "2020-01-01,1,2,0.5,1.5,1,0\nbad,1,2,0.5,1.5,1,0\n2020-01-12,1,,0.5,1.5,1,0\n2020-01-13,1,2,0.5,1.5,0,0\n"
        (tmp_path / "raw" / "Stocks" / f"s{k}.us.txt").write_text(HEADER + rows + "2020-01-14,1,2,3,4,5,6,7\n")
    return str(tmp_path / "raw")


def test_ingest_counts_as_it_writes(spark, base, tmp_path):
    found = daily_run.ingest_counted(spark, base, str(tmp_path / "bars"), rejects_out=str(tmp_path / "rejects"))
    want = {
        "rows_in": 84, "missing_removed": 6, "duplicates_removed": 6, "zero_volume_removed": 6,
        "bad_dates_removed": 6, "rows_out": 60,
    }
    assert found.counts == want and found.bars.count() == 60
    assert {(r.record, r.reason) for r in found.rejects.collect()} == {(16, "more cells than columns")}
    assert found.rejects.count() == 6


def test_counts_equal_the_report(spark, tmp_path):
    rows = [(f"2020-01-{k % 30 + 1:02d}" if k % 7 else "x", None if k % 5 == 0 else float(k % 3), k % 4, f"S{k % 6}") for k in range(400)]
    df = spark.createDataFrame(rows, "Date string, Close double, Volume bigint, symbol string").repartition(4)
    for drop in (True, False):
        bars, counts = cleaning.counted_clean_bars(df, drop)
        bars.write.parquet(str(tmp_path / f"out{drop}"))
        assert counts() == cleaning.cleaning_report(df, drop).first().asDict()


def test_bucketed_tables_are_read_without_an_exchange(spark, tmp_path):
    rows = [(f"S{s}", dt.date(2020, 1, 1) + dt.timedelta(d), 10.0 + s + d % 7, 0.1 * d) for s in range(20) for d in range(30)]
    bars = spark.createDataFrame(rows, "symbol string, date date, close double, target_5 double")
    table = tables.write_bucketed(bars, "bars_in_buckets", 4, str(tmp_path / "bars"))
    try:
        for build in (features.add_returns, features.add_momentum, features.add_zscores, features.add_targets):
            df = build(table)
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
            assert df.orderBy("symbol", "date").collect() == build(bars).orderBy("symbol", "date").collect()
        smooth = crosssection.add_smooth_target(table)
        assert "Exchange" not in smooth._jdf.queryExecution().executedPlan().toString()
        counts = table.groupBy("symbol").agg(F.count(F.lit(1)))
        assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE bars_in_buckets")


def test_entry_without_the_training_data_package(monkeypatch):
    """A module that can't be imported leaves the other queries as they are."""
    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("tickerloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tickerloom.llm", None)
    try:
        bare = importlib.reload(entry)
        assert "feature_table" in bare.queries() and "pipeline" not in bare.queries()
        assert set(bare.oracle_sql()) <= set(bare.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
