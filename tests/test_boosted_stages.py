"""What the boosted queries write."""

import pytest
from pyspark.sql import functions as F
from test_boosting import COLUMNS, frame, made

from tickerloom.plans import boosting
from tickerloom.registry import queries


def test_rounded_rows_are_written_as_whole_numbers(spark, monkeypatch):
    written = []
    staged = queries.staged
    monkeypatch.setattr(queries, "staged", lambda df: written.append(df) or staged(df))
    values = [0.1234565, -0.1234565, 2.5, -0.0, 1e-9, -1e-9, 123456.789, None]
    df = spark.createDataFrame([(f"S{k}", v, k) for k, v in enumerate(values)], "symbol string, v double, k int")
    found = queries._millionths(df)
    assert [dict(d.dtypes)["v"] for d in written] == ["bigint"]
    assert found.dtypes == df.dtypes
    one, other = (d.orderBy("symbol").collect() for d in (found, queries.rounded(df)))
    assert one == other and str(one) == str(other)


@pytest.mark.parametrize("patience, stages", [(None, 2), (5, 3)])
def test_no_scores_are_written_that_nothing_reads(spark, monkeypatch, patience, stages):
    written = []
    staged = boosting.staged
    monkeypatch.setattr(boosting, "staged", lambda df, *a, **b: written.append(staged(df, *a, **b)) or written[-1])
    monkeypatch.setattr(boosting, "delete", lambda *a: None)
    options = dict(max_leaves=4, row_share=1, column_share=1)
    model = boosting.fit(frame(spark, made(300, seed=12, held=0.2)), COLUMNS, 2, 0.3, patience=patience, **options)
    assert model.trained == 2 and len(written) == stages
    # Rows that are all drawn need no number.
    assert written[0].agg(F.countDistinct("row")).first()[0] == 1
