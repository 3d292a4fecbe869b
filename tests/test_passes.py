"""How often large tables are read, moved and written."""

import datetime
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickerloom import fixtures
from tickerloom.operators import lineage, selection
from tickerloom.plans import boosting, feature_table
from tickerloom.registry import queries

SYMBOLS, DAYS = 7, 130


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A folder with the lines of a few suppliers, one of them without a key."""
    rng = np.random.default_rng(5)
    n = SYMBOLS * DAYS
    start = datetime.datetime(2020, 1, 1)
    folder = tmp_path_factory.mktemp("lines")
    lines = pa.table(
        {
            "l_suppkey": pa.array([None if k == 0 else k for k in range(SYMBOLS) for _ in range(DAYS)], pa.int64()),
            "l_shipdate": pa.array(
                [start + datetime.timedelta(days=d) for _ in range(SYMBOLS) for d in range(DAYS)], pa.timestamp("us")
            ),
            "l_extendedprice": np.round(rng.uniform(10, 1000, n), 2),
            "l_quantity": rng.integers(1, 50, n).astype(float),
        }
    )
    pq.write_table(lines, folder / "lineitem.parquet")
    return str(folder)


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def test_bars_reach_their_windows_with_one_exchange(spark, tables):
    df = queries.returns(spark, tables)
    df.count()
    assert len(re.findall(r"\bExchange hashpartitioning", _plan(df)[1].split("Initial Plan")[-1])) == 1


def test_many_symbols_read_the_lines_once_after_the_stages(spark, tables):
    bars = fixtures.bars(spark, tables)
    sizes = fixtures.symbol_sizes(spark, tables)
    few = feature_table.feature_table(bars, sizes=sizes)
    many = feature_table.feature_table(bars, sizes=sizes, symbols_per_task=2)
    assert _rows(queries.rounded(many)) == _rows(queries.rounded(few))
    assert _plan(many)[0].count("lineitem.parquet") == 1


def test_training_table_writes_the_features_once(spark, tables, monkeypatch):
    written = []
    staged = lineage.staged

    def count(df, *args, **options):
        written.append(len(df.columns))
        return staged(df, *args, **options)

    monkeypatch.setattr(lineage, "staged", count)
    assert queries.training_table(spark, tables).count() > 0
    assert sum(n > 20 and n < 50 for n in written) == 1


def test_a_task_sends_one_row_of_counts_for_each_column(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=20_000)
    df = spark.createDataFrame(pa.table({"a": values, "b": -values})).repartition(3)
    cells = [np.zeros(1, np.uint64)] * 2
    sent = df.mapInArrow(selection._count_digits(["a", "b"], cells, 0, 16), selection.SUMS)
    assert sent.count() <= 2 * 3
    places = [0, 77, 9_999, 19_999]
    found = selection.values_at(df, {"a": places, "b": places}, finish_rows=10)
    assert np.array_equal(found["a"], np.sort(values)[places])
    assert np.array_equal(found["b"], np.sort(-values)[places])


def test_rows_walk_through_no_finished_tree(spark, monkeypatch):
    rows = spark.range(0, 600, 1, 2).select(
        F.col("id").alias("_row"), (F.col("id") % 37).cast("double").alias("x"),
        (F.col("id") % 7).cast("double").alias("_y"), F.lit(1.0).alias("_w"), (F.col("id") % 10 == 0).alias("_held"),
    )
    finished = []
    histograms = boosting.histograms

    def watch(state, width, trees, *args):
        finished.append(len(trees))
        return histograms(state, width, trees, *args)

    monkeypatch.setattr(boosting, "histograms", watch)
    model = boosting.fit(rows, ["x"], max_trees=3, max_leaves=4, patience=None)
    assert len(model.trees) == 3
    assert max(finished) == 0
