"""CSV files with line ends inside quotes, against Spark's reader of whole files."""

from __future__ import annotations

import csv
import random

import pytest

from orderlake.sources.csv_files import read_csv
from orderlake.sources.csv_records import lines, read_records, records

COLUMNS = ["review_id", "order_id", "review_score", "comment"]


def by_one_task(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def comment(rng):
    return "".join(rng.choice(["word ", "two words", "\n", "\r\n", '"', ',', "", "é", "\n\n", '""', "  "]) for _ in range(rng.randrange(8)))


def written(path, seed, n, end="\n"):
    rng = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        out.writerow(COLUMNS)
        for i in range(n):
            out.writerow([f"r{i}", f"o{i % 7}", i % 5 + 1, comment(rng)])
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def small_blocks(spark):
    """Blocks of some hundred bytes, so that records and quotes lie across many."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\r\n"), (3, "\n"), (4, "\n")])
def test_rows_are_those_of_one_task(spark, tmp_path, small_blocks, seed, end):
    path = written(tmp_path / "reviews.csv", seed, 300, end)
    assert lines(spark, path).rdd.getNumPartitions() > 20
    got, want = read_records(spark, path, COLUMNS), by_one_task(spark, path)
    assert got.columns == want.columns
    assert rows(got) == rows(want) and got.count() == 300


def test_several_files(spark, tmp_path, small_blocks):
    for seed in (5, 6, 7):
        written(tmp_path / f"{seed}.csv", seed, 60)
    assert rows(read_records(spark, str(tmp_path), COLUMNS)) == rows(by_one_task(spark, str(tmp_path)))


def test_records_are_numbered_in_order(spark, tmp_path, small_blocks):
    path = written(tmp_path / "reviews.csv", 8, 200)
    numbered = sorted((r.number, r.record.split(",")[0].strip('"')) for r in records(spark, path).collect())
    assert [name for _, name in numbered] == ["review_id", *(f"r{i}" for i in range(200))]


def test_blank_lines_and_a_missing_last_line_end(spark, tmp_path, small_blocks):
    path = tmp_path / "reviews.csv"
    path.write_text('review_id,order_id,review_score,comment\n\nr1,o1,5,"a\n\nb"\n\n\nr2,o2,4,""\nr3,o3,,"x"', encoding="utf-8")
    got = rows(read_records(spark, str(path), COLUMNS))
    assert got == rows(by_one_task(spark, str(path))) and len(got) == 3


def test_a_record_longer_than_blocks(spark, tmp_path, small_blocks):
    path = tmp_path / "reviews.csv"
    long = "\n".join(f'line ""{i}"" of many, with commas' for i in range(500))
    path.write_text(f'review_id,order_id,review_score,comment\nr1,o1,5,"{long}"\nr2,o2,4,short\n', encoding="utf-8")
    got = rows(read_records(spark, str(path), COLUMNS))
    assert got == rows(by_one_task(spark, str(path))) and got[0][3].count("\n") == 499


def test_open_quotes_fail(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('review_id,order_id,review_score,comment\nr1,o1,5,"never closed\nr2,o2,4,x\n', encoding="utf-8")
    with pytest.raises(Exception, match="quotes do not even out"):
        read_records(spark, str(path), COLUMNS).collect()


def test_raw_reviews(spark, tmp_path, small_blocks):
    """Typed as declared, other columns kept as text; header alone gives no rows."""
    path = written(tmp_path / "order_reviews_dataset.csv", 9, 80)
    got = read_csv(spark, path, "order_reviews")
    assert got.dtypes == [("review_id", "string"), ("order_id", "string"), ("review_score", "int"), ("comment", "string")]
    assert got.count() == 80
    empty = tmp_path / "empty.csv"
    empty.write_text(",".join(COLUMNS) + "\n")
    assert read_csv(spark, str(empty), "order_reviews").count() == 0
