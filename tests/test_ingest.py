"""Ticker files, symbol lists, cleaning and prechecks on small hand-made files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerloom.functions.names import extract_symbol, extract_ticker
from tickerloom.operators import cleaning, universe
from tickerloom.plans import daily_run
from tickerloom.sources import tables, ticker_files

HEADER = "Date,Open,High,Low,Close,Volume,OpenInt\n"


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    stocks, etfs = root / "Stocks", root / "ETFs"
    stocks.mkdir()
    etfs.mkdir()
    (stocks / "aapl.us.txt").write_text(
        HEADER + "2020-01-02,1,2,0.5,1.5,100,0\n2020-01-03,1.5,2,1,1.75,0,0\nbad,1,1,1,1,5,0\n"
    )
    # Another column order, Windows line ends, one column more, one less.
    (stocks / "MSFT.us.txt").write_bytes(
        b"Close,Date,Open,High,Low,Volume,Note\r\n3.5,2020-01-02,3,4,2.5,50,x\r\n"
    )
    (stocks / "empty.us.txt").write_text("")
    (stocks / "readme.md").write_text("not data")
    (etfs / "spy.us.txt").write_text(
        HEADER + "2020-01-02,10,11,9,10.5,70,0\n2020-01-02,10,11,9,10.5,70,0\n2020-01-03,10,,9,10,70,0\n"
    )
    return str(root)


def test_merge_matches_columns_by_name(spark, base):
    merged = ticker_files.merge_folders(spark, base)
    assert set(merged.columns) == {
        "Date", "Open", "High", "Low", "Close", "Volume", "OpenInt", "Note", "symbol", "type",
    }
    rows = {(r.symbol, r.Date): r for r in merged.collect()}
    assert rows["MSFT", "2020-01-02"].Close == 3.5
    assert rows["MSFT", "2020-01-02"].Open == 3.0
    assert rows["MSFT", "2020-01-02"].OpenInt is None
    assert rows["MSFT", "2020-01-02"].Note == "x"
    assert rows["AAPL", "2020-01-02"].type == "stock"
    assert rows["SPY", "2020-01-03"].High is None
    assert merged.count() == 7


def test_one_kind_only(spark, base):
    etfs = ticker_files.merge_folders(spark, base, "etfs")
    assert {r.type for r in etfs.select("type").distinct().collect()} == {"etf"}
    with pytest.raises(ValueError):
        ticker_files.source_folders(base, "bonds")
    with pytest.raises(FileNotFoundError):
        ticker_files.merge_folders(spark, base + "/nowhere")


def test_read_ticker(spark, base):
    for name in ("aapl", " AAPL"):
        df = ticker_files.read_ticker(spark, base + "/Stocks", name)
        assert df.count() == 3
        assert df.where(F.col("Date").isNull()).count() == 1
    with pytest.raises(FileNotFoundError):
        ticker_files.read_ticker(spark, base + "/Stocks", "IBM")


def test_manifest_lists_empty_files(spark, base):
    files = ticker_files.file_manifest(spark, base + "/Stocks").collect()
    assert {(r.file_name, r.length == 0) for r in files} == {
        ("aapl.us.txt", False),
        ("MSFT.us.txt", False),
        ("empty.us.txt", True),
    }


def test_universe(spark, base, tmp_path):
    listing = tmp_path / "symbols.csv"
    listing.write_text("Symbol\naapl\n EMPTY \nMETA\n\nAAPL\n")
    symbols = universe.symbol_set(ticker_files.read_symbols(spark, str(listing)))
    assert {r.ticker for r in symbols.collect()} == {"AAPL", "EMPTY", "META"}
    manifest = ticker_files.file_manifest(spark, base + "/Stocks")
    assert [tuple(r) for r in universe.matched_files(manifest, symbols).collect()] == [
        ("AAPL", "aapl.us.txt", "Stocks/aapl.us.txt")
    ]
    assert [r.ticker for r in universe.empty_files(manifest, symbols).collect()] == ["EMPTY"]
    assert [r.ticker for r in universe.missing_symbols(manifest, symbols).collect()] == ["META"]
    summary = universe.filter_summary(manifest, symbols).first()
    assert summary.asDict() == {
        "total_files": 3, "empty_files": 1, "matched_files": 1, "matched_empty_files": 1,
        "symbols": 3, "mode": "ignore",
    }
    assert universe.filter_summary(manifest, symbols, 0).first()["mode"] == "skip"


def test_universe_run(spark, base, tmp_path):
    listing = tmp_path / "symbols.csv"
    listing.write_text("Symbol\nmsft\naapl\nEMPTY\nMETA\n")
    paths = daily_run.select_universe(spark, base, str(listing), str(tmp_path / "out"))
    assert sorted(paths) == ["matched", "missing", "summary"]
    matched = spark.read.csv(paths["matched"], header=True).collect()
    assert [(r.ticker, r.file_path) for r in matched] == [
        ("AAPL", "Stocks/aapl.us.txt"), ("MSFT", "Stocks/MSFT.us.txt"),
    ]
    assert [r.ticker for r in spark.read.csv(paths["missing"], header=True).collect()] == ["META"]
    paths = daily_run.select_universe(spark, base, str(listing), str(tmp_path / "skip"), 0)
    assert spark.read.csv(paths["summary"], header=True).first()["mode"] == "skip"
    assert spark.read.csv(paths["empty"], header=True).first()["file_path"] == "Stocks/empty.us.txt"


def test_first_column_of_a_list_without_symbol_header(spark):
    df = spark.createDataFrame([("ibm", "x"), (None, "y")], "code string, Other string")
    assert [r.ticker for r in universe.symbol_set(df).collect()] == ["IBM"]


def test_names(spark):
    expected = {
        "a.us.txt": ("A", "A"),
        "MSFT.US.TXT": ("MSFT.US", "MSFT"),
        "b.us.txt.us.txt": ("B", "B.US.TXT"),
        "notes.csv": ("NOTES", ""),
        "plain": ("PLAIN", ""),
        ".hidden": (".HIDDEN", ""),
        "x..y": ("X.", ""),
    }
    df = spark.createDataFrame([(n,) for n in expected], "f string")
    rows = df.select("f", extract_symbol("f").alias("s"), extract_ticker("f").alias("t")).collect()
    assert {r.f: (r.s, r.t) for r in rows} == expected


def test_clean_and_report(spark):
    inf = float("inf")
    rows = [
        ("2020-01-02", 1.0, 10, "A"),
        ("2020-01-02", 1.0, 10, "A"),
        ("2020-01-03", inf, 10, "A"),
        ("2020-01-04", float("nan"), 10, "A"),
        ("2020-01-05", 1.0, 0, "A"),
        ("05.01.2020", 1.0, 10, "A"),
        (None, 1.0, 10, "A"),
        ("2020-01-06", 2.0, 10, "A"),
    ]
    df = spark.createDataFrame(rows, "Date string, Close double, Volume bigint, symbol string")
    clean = cleaning.clean_bars(df)
    assert sorted(r.Date for r in clean.collect()) == [dt.date(2020, 1, 2), dt.date(2020, 1, 6)]
    assert cleaning.cleaning_report(df).first().asDict() == {
        "rows_in": 8, "missing_removed": 3, "duplicates_removed": 1, "zero_volume_removed": 1,
        "bad_dates_removed": 1, "rows_out": 2,
    }
    assert cleaning.clean_bars(df, drop_zero_volume=False).count() == 3
    assert cleaning.clean_bars(df, date_formats=["dd.MM.yyyy"]).count() == 3


def test_typed(spark):
    df = spark.createDataFrame(
        [("2020-01-02", "1.5", 7, "Stock", "A"), ("x", "2", 3_000_000_000, "ETF", "B")],
        "Date string, Open string, Volume bigint, type string, symbol string",
    )
    typed = cleaning.typed_bars(df)
    assert typed.dtypes == [
        ("date", "date"), ("open", "double"), ("volume", "bigint"), ("type", "tinyint"),
        ("symbol", "string"),
    ]
    rows = typed.orderBy("symbol").collect()
    assert [(r.type, r.volume, r.date) for r in rows] == [
        (0, 7, dt.date(2020, 1, 2)), (1, 3_000_000_000, None),
    ]
    odd = df.withColumn("type", F.lit("bond"))
    assert {r.type for r in cleaning.typed_bars(odd, strict=False).collect()} == {None}
    with pytest.raises(Exception, match="unknown type: bond"):
        cleaning.typed_bars(odd).collect()


def test_guardrail(spark):
    good = spark.createDataFrame(
        [("2020-01-02", 1.0, 1.0, 1.0, 1.0, 5, 0)],
        "Date string, Open double, High double, Low double, Close double, Volume bigint, OpenInt bigint",
    )
    assert all(r.ok for r in cleaning.guardrail(good).collect())
    bad = good.drop("OpenInt").withColumns(
        {"Date": F.lit("?"), "Volume": F.lit(-1).cast("bigint"), "Low": F.lit(None).cast("double")}
    )
    found = {r.check_name: (r.observed, r.ok) for r in cleaning.guardrail(bad).collect()}
    assert found == {
        "missing_columns": (1, False), "invalid_dates": (1, False), "missing_values": (2, False),
        "negative_volume": (1, False), "all": (4, False),
    }


def test_ingest_run_and_sinks(spark, base, tmp_path):
    bars = daily_run.ingest(spark, base, str(tmp_path / "bars"), kind="etfs")
    assert [(r.symbol, r.date, r.type, r.close) for r in bars.collect()] == [
        ("SPY", dt.date(2020, 1, 2), 1, 10.5)
    ]
    tables.write_bars(bars, str(tmp_path / "by_year"), by_year=True)
    assert (tmp_path / "by_year" / "year=2020").is_dir()
    tables.write_universe(bars, str(tmp_path / "universe"))
    assert (tmp_path / "universe" / "symbol=SPY").is_dir()
    tables.write_csv(bars, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == bars.columns
