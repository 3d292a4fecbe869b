"""What the training table writes, and its statistics by date against plain ones."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import crosssection, lineage, sampling
from tickerloom.plans import training


def bars(spark, symbols=4, days=60):
    rng = random.Random(11)
    rows = [
        (
            f"S{s}", dt.date(2021, 1, 1) + dt.timedelta(d), rng.gauss(5, 2), None if rng.random() < 0.2 else rng.gauss(0, 1),
            None if rng.random() < 0.1 else rng.gauss(0, 1),
        )
        for s in range(symbols) for d in range(days - 10 * s)
    ]
    return spark.createDataFrame(rows, "symbol string, date date, x double, z double, target_5 double").repartition(3)


@pytest.mark.parametrize("train_only", [False, True])
def test_only_rows_by_date_are_written(spark, monkeypatch, train_only):
    written = []
    staged = lineage.staged
    monkeypatch.setattr(lineage, "staged", lambda df, *a, **b: written.append(df) or staged(df, *a, **b))
    table = training.training_table(bars(spark), train_only_scale=train_only)
    assert table.count() > 0
    assert [df.count() for df in written] == [60]


@pytest.mark.parametrize("train_only", [False, True])
def test_same_rows_as_operators_without_statistics(spark, train_only):
    df = bars(spark)
    found = training.training_table(df, train_only_scale=train_only)
    rows = crosssection.add_smooth_target(sampling.min_history(df), "target_5").withColumn("target_raw", F.col("target_5"))
    rows = sampling.split_flag(rows.select("date", "symbol", "x", "z", "target_smooth", "target_raw"))
    rows = crosssection.cross_section_zscore(rows, ["x", "z"]).fillna(0.0, ["x", "z"])
    fit_on = rows.where(~F.col("is_test")) if train_only else None
    want = crosssection.add_time_decay(crosssection.standardise(rows, "target_smooth", fit_on=fit_on))
    assert found.columns == want.columns
    one, other = (d.orderBy("symbol", "date").collect() for d in (found, want))
    assert len(one) == len(other) > 0
    for a, b in zip(one, other):
        for p, q in zip(a, b):
            assert p == q or math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-12)


def test_scale_of_few_values(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1), 2.0), (dt.date(2021, 1, 2), None)], "date date, v double")
    for rows in (df, df.where("v IS NULL")):
        daily = crosssection.date_statistics(rows, ["v"])
        want = crosssection.standardise(rows, "v").collect()
        assert crosssection.standardise(rows, "v", daily=daily).collect() == want
