"""CSV cells with line ends, and what can't be read."""

import os

import pytest
from pyspark.sql import functions as F

from tickerloom.sources import listing, ticker_files

HEADER = "Date,Name,Open,High,Low,Close,Volume,OpenInt\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("broken")
    (root / "lines.us.txt").write_text(
        HEADER + '2020-01-02,"Foo\nInc",1,2,0.5,1.5,10,0\n2020-01-03,"say ""hi"",\r\nFoo",1,2,0.5,1.5,20,0\n'
        "2020-01-04,plain,1,2,0.5,1.5,30,0\n"
    )
    (root / "windows.us.txt").write_bytes(b'date,"Close\r\nprice",Close\r\n2020-01-02,"a\r\nb",7\r\n\r\n2020-01-03,c,8\r\n')
    (root / "extra.us.txt").write_text(
        HEADER + "2020-01-02,x,1,2,0.5,1.5,10,0,surplus\n2020-01-03,x,1,2,0.5,1.5,10,0,,,\n2020-01-04,x,1\n"
    )
    (root / "quote.us.txt").write_text(HEADER + '2020-01-02,x,1,2,0.5,1.5,10,0\n2020-01-03,"open,1,2,0.5,1.5,10,0\n')
    (root / "headless.us.txt").write_text("2020-01-02,x,1,2,0.5,1.5,10,0\n2020-01-03,x,1,2,0.5,1.5,10,0\n")
    (root / "empty.us.txt").write_text("")
    (root / "blank.us.txt").write_text("\n\n")
    return str(root)


@pytest.fixture(scope="module")
def found(spark, folder):
    return ticker_files.read_with_rejects(spark, folder)


def test_cells_with_line_ends(found):
    rows = {(r.file_name[:-7], r.Date): r for r in found[0].collect()}
    assert rows["lines", "2020-01-02"].Name == "Foo\nInc" and rows["lines", "2020-01-02"].Volume == 10
    assert rows["lines", "2020-01-03"].Name.replace("\r", "") == 'say "hi",\nFoo'
    assert rows["lines", "2020-01-04"].Name == "plain"
    assert rows["windows", "2020-01-02"].Close == 7.0 and rows["windows", "2020-01-03"].Close == 8.0
    assert set(rows) == {
        ("lines", "2020-01-02"), ("lines", "2020-01-03"), ("lines", "2020-01-04"), ("windows", "2020-01-02"),
        ("windows", "2020-01-03"), ("extra", "2020-01-03"), ("extra", "2020-01-04"), ("quote", "2020-01-02"),
    }
    assert rows["extra", "2020-01-04"].Close is None and rows["extra", "2020-01-04"].Open == 1.0
    assert {c for c in found[0].columns if c not in ticker_files.RAW_BARS.names} >= {"Name", "file_name"}


def test_rejects(found):
    rejects = {(r.file_name[:-7], r.record): (r.reason, r.text) for r in found[1].collect()}
    assert {k: v[0] for k, v in rejects.items()} == {
        ("extra", 2): "more cells than columns",
        ("quote", 3): "a quote is not closed",
        ("headless", None): "no column Date in the first record",
        ("empty", None): "empty",
        ("blank", None): "no record can be read",
    }
    assert rejects["extra", 2][1].endswith("surplus")


def test_same_rows_without_rejects(spark, folder, found):
    plain = ticker_files.read_by_header(spark, folder)
    order = ["file_name", "Date"]
    assert plain.orderBy(*order).collect() == found[0].orderBy(*order).collect()


def test_split_files(spark, tmp_path):
    lines = "".join(f"2020-01-{k % 28 + 1:02d},n{k},1,2,0.5,1.5,{k},0\n" for k in range(5000))
    (tmp_path / "big.us.txt").write_text(HEADER + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = ticker_files.read_by_header(spark, str(tmp_path), multi_line=False)
        assert rows.rdd.getNumPartitions() > 3
        assert rows.agg(F.count("*"), F.sum("Volume")).first()[:] == (5000, sum(range(5000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_merge_with_rejects(spark, tmp_path):
    for name in ("Stocks", "ETFs"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.us.txt").write_text(HEADER + "2020-01-02,x,1,2,0.5,1.5,10,0\n")
        (tmp_path / name / "b.us.txt").write_text("")
    merged, rejects = ticker_files.merge_with_rejects(spark, str(tmp_path))
    assert sorted(r.type for r in merged.collect()) == ["etf", "stock"]
    assert [tuple(r) for r in rejects.select("file_name", "reason").collect()] == [("b.us.txt", "empty")] * 2


def test_listing(spark, tmp_path):
    for k in range(30):
        inner = tmp_path / f"d{k % 3}" / f"e{k % 5}"
        inner.mkdir(parents=True, exist_ok=True)
        (inner / f"f{k}.us.txt").write_text("x" * (k % 4))
        (inner / f".hidden{k}.us.txt").write_text("x")
        (inner / f"other{k}.md").write_text("x")
    found = listing.list_files(spark, [str(tmp_path)], "*.us.txt", recursive=True)
    assert sorted(r.file_name for r in found.collect()) == sorted(f"f{k}.us.txt" for k in range(30))
    assert all(os.path.getsize(r.path) == r.length for r in found.collect())
    assert listing.list_files(spark, [str(tmp_path)], "*.us.txt").count() == 0
    assert listing.list_files(spark, [str(tmp_path / "nowhere")], recursive=True).count() == 0
