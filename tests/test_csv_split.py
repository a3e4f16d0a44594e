"""CSV read by byte ranges, and parts below one header."""

import csv
import glob
import io

import pytest

from corpusmill.sources import csv_split as CS
from corpusmill.sources import sinks as SK

HEADERS = ["name", "text", "more"]


@pytest.fixture()
def small_ranges(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def _rows(n):
    hostile = ['plain', 'quote " inside', '"', '""', 'line\nbreak', '\n', 'ends with\n', '\nstarts', 'comma, "and\nbreak"', ' blanks ',
               '', 'ü\r\nwindows', 'back\\slash"', 'x' * 300, 'long\n' * 90, '"\n' * 60, ',\n",\n"', 'tab\t']
    return [(f"r{i}", hostile[i % len(hostile)], hostile[(i * 7 + 3) % len(hostile)]) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 18, 400])
def test_equals_multiline_read(small_ranges, tmp_path, n):
    spark = small_ranges
    rows = _rows(n)
    df = spark.createDataFrame(rows, ", ".join(f"{h} STRING" for h in HEADERS)).coalesce(2)
    out = str(tmp_path / "csv")
    SK.write_csv(df, out, HEADERS)
    got = CS.read_csv_split(spark, out, HEADERS, glob="*.csv")
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)
    assert sorted(tuple(r) for r in SK.read_csv(spark, out, HEADERS).collect()) == sorted(rows)
    if n == 400:
        lines = CS._lines(spark, out, "*.csv")
        assert lines.select("file", "start").distinct().count() > 100
        assert CS._ranges(lines).where("opened").count() > 10


def test_shuffled_ranges_give_the_same(small_ranges, tmp_path, monkeypatch):
    spark = small_ranges
    rows = _rows(120)
    out = str(tmp_path / "csv")
    SK.write_csv(spark.createDataFrame(rows, ", ".join(f"{h} STRING" for h in HEADERS)).coalesce(1), out, HEADERS)
    monkeypatch.setattr(CS, "BROADCAST_RANGES", 0)
    got = CS.read_csv_split(spark, out, HEADERS, glob="*.csv")
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_file_of_the_csv_module(small_ranges, tmp_path):
    rows = _rows(60)
    path = tmp_path / "one.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(HEADERS)
        w.writerows(rows)
    got = CS.read_csv_split(small_ranges, str(path), HEADERS)
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_unclosed_quote_is_an_error(small_ranges, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('name,text,more\na,"b,c\nd,e,f\n')
    with pytest.raises(Exception, match="ends inside a quoted value"):
        CS.read_csv_split(small_ranges, str(path), HEADERS).collect()


def test_parts_below_one_header(spark, tmp_path):
    rows = sorted(_rows(200))
    df = spark.createDataFrame(rows, ", ".join(f"{h} STRING" for h in HEADERS)).repartition(3).orderBy("name")
    out = str(tmp_path / "csv")
    CS.write_csv_ordered(df, out, HEADERS)
    text = "".join(open(f, encoding="utf-8", newline="").read() for f in sorted(glob.glob(f"{out}/*.csv")))
    want = io.StringIO()
    w = csv.writer(want, lineterminator="\n")
    w.writerow(HEADERS)
    w.writerows(rows)
    assert list(csv.reader(io.StringIO(text, newline=""))) == list(csv.reader(io.StringIO(want.getvalue(), newline="")))
    back = CS.read_csv_split(spark, out, HEADERS, glob="part-*", header=False)
    assert sorted(tuple(r) for r in back.collect()) == rows
