"""CSV files cut into small byte ranges give the records that one reader of the whole file finds."""

from __future__ import annotations

import csv
import io
import random

import pytest

from salesgrain.sources import platform_csv
from salesgrain.sources.csv_records import csv_records

PIECES = ("a", "bc d", '"', '""', ",", "\n", "\r\n", "é", " ", "x,\"y\",\n", '",', ',"')


@pytest.fixture()
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def read_whole(spark, folder, width):
    """The same folder by Spark's reader, which takes a file in one task."""
    cells = [f"c{i}" for i in range(width)]
    whole = (
        spark.read.schema(", ".join(f"{c} string" for c in cells)).option("recursiveFileLookup", True)
        .option("multiLine", True).option("escape", '"').csv(folder)
    )
    return sorted([[c or "" for c in r] for r in whole.collect()])


def by_file(rows_of):
    out: dict[str, list] = {}
    for r in sorted(rows_of.collect(), key=lambda r: (r["file"], tuple(r["position"]))):
        out.setdefault(r["file"].split("/")[-1], []).append(r["cells"])
    return out


@pytest.mark.parametrize("line_end", ["\r\n", "\n"])
def test_records_over_many_ranges(spark, tmp_path, small_ranges, line_end):
    rng = random.Random(len(line_end))
    want = {}
    for n in range(4):
        records = [["first", "second"]] + [
            ["".join(rng.choices(PIECES, k=rng.randrange(9))) or "-" for _ in range(rng.randrange(1, 5))] for _ in range(60)
        ]
        out = io.StringIO()
        csv.writer(out, lineterminator=line_end, quoting=csv.QUOTE_ALL if n == 3 else csv.QUOTE_MINIMAL).writerows(records)
        (tmp_path / f"{n}.csv").write_bytes((b"\xef\xbb\xbf" if n % 2 else b"") + out.getvalue().encode())
        want[f"{n}.csv"] = records
    got = by_file(platform_csv.read_rows(spark, str(tmp_path)))
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 40
    assert {f: [[c for c in r[: len(w)]] for r, w in zip(got[f], want[f])] for f in want} == want
    assert all(len(got[f]) == len(want[f]) and not any("".join(r[len(w):]) for r, w in zip(got[f], want[f])) for f in want)


def test_one_record_over_many_ranges_and_an_open_end(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, of \"many\"" for i in range(200))
    out = io.StringIO()
    csv.writer(out).writerows([["a", "b"], [long, "1"], ["x", "2"]])
    (tmp_path / "long.csv").write_text(out.getvalue() + 'y,"never closed\nat all', newline="")
    got = by_file(platform_csv.read_rows(spark, str(tmp_path)))["long.csv"]
    assert [r[:2] for r in got[:3]] == [["a", "b"], [long, "1"], ["x", "2"]]
    assert sorted(r[:3] for r in got) == read_whole(spark, str(tmp_path), 3) and len(got) == 4


def test_stray_quotes_and_blank_lines_as_the_reader_of_whole_files(spark, tmp_path, small_ranges):
    text = 'a,b\n\n5" pipe,x\n  \n"q"rest,y\n"",""\n,\n"a ""b""",c"d"\n7",8"\nlast,"x\n\ny"'
    (tmp_path / "odd.csv").write_text(text, newline="")
    got = by_file(platform_csv.read_rows(spark, str(tmp_path)))["odd.csv"]
    assert sorted(r[:3] for r in got) == read_whole(spark, str(tmp_path), 3)


def test_no_task_takes_a_whole_file(spark, tmp_path, small_ranges):
    (tmp_path / "big.csv").write_text("a,b\n" + "".join(f'{i},"t\n{i}"\n' for i in range(800)))
    records = csv_records(spark, str(tmp_path), "*.csv")
    assert records.count() == 801
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert max(lines.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()) < 40
