"""CSV files with line breaks inside quotes, cut into blocks of any place, against one reader of the whole file."""

from __future__ import annotations

import random

import pytest

from ordersight.sources import csv_files
from ordersight.sources.quoted_lines import read_records

HEADER = ",".join(csv_files.RAW_COLUMNS["reviews"])


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 97 bytes."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def text(draw, end):
    kind = draw.randrange(6)
    if kind == 0:
        return draw.choice(["", "plain", 'five 5" disk', "x y", " z"])
    if kind == 1:
        return '""'
    parts = [draw.choice(["a", ",", '""', end, "b c", f"{end}{end}", 'q""', f'"",{end}', "é"]) for _ in range(draw.randrange(1, 30))]
    return '"' + "".join(parts) + '"'


def review(draw, number, end):
    return ",".join([f"r{number}", f"o{number}", "5", text(draw, end), text(draw, end), "2018-01-10", ""])


def write(folder, name, seed, end, rows=40, last=True):
    draw = random.Random(seed)
    lines = [HEADER]
    for k in range(rows):
        lines.append(review(draw, k, end))
        if draw.random() < 0.1:
            lines.append("")
    (folder / name).write_bytes((end.join(lines) + (end if last else "")).encode())


@pytest.mark.parametrize("seed,end,last", [(1, "\n", True), (2, "\r\n", False)])
def test_blocks_give_the_rows_of_one_reader(spark, tmp_path, small_blocks, seed, end, last):
    for k in range(2):
        write(tmp_path, f"part{k}.csv", 10 * seed + k, end, last=last)
    names = csv_files.RAW_COLUMNS["reviews"]
    wanted = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path)).select(*names)
    nothing = set(csv_files.NULL_TEXTS)
    wanted = [tuple(None if v in nothing else v for v in r) for r in wanted.collect()]
    rows = csv_files._read_csv(spark, str(tmp_path), "reviews", True, True).collect()
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted((tuple(r[n] for n in names) for r in rows), key=key) == sorted(wanted, key=key)
    assert len({(r._file, r._block) for r in rows}) > 10
    # The place of a row is its order in the file.
    for file in {r._file for r in rows}:
        mine = sorted((r for r in rows if r._file == file), key=lambda r: (r._block, r._row))
        assert [r.review_id for r in mine] == [f"r{k}" for k in range(40)]


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {k} with ""quotes"", commas' for k in range(80))
    (tmp_path / "reviews.csv").write_text(f'{HEADER}\nr0,o0,1,,"{long}",,\nr1,o1,2,,,,\n')
    rows = csv_files._read_csv(spark, str(tmp_path / "reviews.csv"), "reviews", True, True).collect()
    found = {r.review_id: r.review_comment_message for r in rows}
    assert found == {"r0": long.replace('""', '"'), "r1": None}


def test_empty_files_and_open_quotes(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(HEADER + "\n")
    assert csv_files._read_csv(spark, str(tmp_path / "reviews.csv"), "reviews", True, True).count() == 0
    (tmp_path / "open.csv").write_text(f'{HEADER}\nr0,o0,1,,"never closed,,\nr1,o1,2,,,,\n')
    assert read_records(spark, str(tmp_path / "open.csv")).count() == 2


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\nr0,o0,1,,,,\n")
    names = HEADER.split(",")
    (tmp_path / "b.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\no1,r1,1,,,,\n")
    with pytest.raises(Exception, match="header"):
        csv_files._read_csv(spark, str(tmp_path), "reviews", True, True).collect()
