"""CSV cells, whole numbers, and tables written by year."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerloom.schema import feature_columns
from tickerloom.sources import tables, ticker_files

BIG = 2**53 + 1


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("cells")
    (root / "a.us.txt").write_text(
        'Date,Name,Open,High,Low,Close,Volume,OpenInt\n'
        f'2020-01-02,"Foo, Inc",1,2,0.5,1.5,{BIG},0\n'
        '2020-01-03,"say ""hi"", Foo",1,2,0.5,1.5,70.0,1.7\n'
        "2020-01-04,plain,x,,0.5,1e2,1e3,\n"
    )
    (root / "b.us.txt").write_text('"Close","Date",Volume\n3.5,2020-01-02,5\n')
    return str(root)


def test_cells(spark, folder):
    rows = {(r.file_name, r.Date): r for r in ticker_files.read_by_header(spark, folder).collect()}
    assert len(rows) == 4
    first, second, third = (rows["a.us.txt", f"2020-01-0{d}"] for d in (2, 3, 4))
    assert (first.Name, first.Open, first.High, first.Low, first.Close) == ("Foo, Inc", 1.0, 2.0, 0.5, 1.5)
    assert (first.Volume, first.OpenInt) == (BIG, 0)
    assert second.Name == 'say "hi", Foo' and (second.Volume, second.OpenInt) == (70, None)
    assert (third.Open, third.High, third.Close, third.Volume, third.OpenInt) == (None, None, 100.0, 1000, None)
    other = rows["b.us.txt", "2020-01-02"]
    assert (other.Close, other.Volume, other.Name, other.Open) == (3.5, 5, None, None)


def test_many_column_names(spark, tmp_path):
    names = ",".join(f"c{k}" for k in range(60))
    (tmp_path / "a.us.txt").write_text(f"Date,{names}\n2020-01-02,{names}\n")
    row = ticker_files.read_by_header(spark, str(tmp_path)).first()
    assert row.Date == "2020-01-02" and row.c59 == "c59"


def test_year_folder_is_no_feature(spark, tmp_path):
    rows = [("A", dt.date(2019 + k, 1, 2), float(k)) for k in range(3)]
    bars = spark.createDataFrame(rows, "symbol string, date date, close double")
    tables.write_bars(bars, str(tmp_path / "bars"), by_year=True)
    back = tables.read_table(spark, str(tmp_path / "bars"))
    assert "year" in back.columns and feature_columns(back) == ["close"]
    assert sorted(map(tuple, back.select("symbol", "date", "close").collect())) == rows
    assert back.where(F.col("year") == 2020).count() == 1


def test_scratch_is_deleted(spark):
    import os

    from tickerloom.sources.stages import scratch, staged

    df = spark.range(10)
    kept = staged(df)
    with scratch(spark) as folder:
        assert staged(staged(df).where("id > 4")).count() == 5
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and kept.count() == 10
