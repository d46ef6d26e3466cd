import csv
import io
import random

import pytest
from helpers import rows

from jobgrain.sources import postings, split_csv

HEADER = ["job_id", "title", "description"]


@pytest.fixture()
def tiny_splits(spark):
    """Splits of 160 bytes, each a partition of its own."""
    changed = {"spark.sql.files.maxPartitionBytes": "160", "spark.sql.files.openCostInBytes": "160"}
    before = {k: spark.conf.get(k) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def plain(spark, path, schema=None):
    return postings._typed(spark.read.options(**postings.csv_options()).csv(path), schema)


def write(path, records, end="\n", header=HEADER):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows([header, *records])
    path.write_bytes(out.getvalue().encode())


def test_a_break_at_each_of_the_first_offsets(spark, tiny_splits, tmp_path):
    for k in range(200):
        records = [[1, "x" * k + "\nend", 'a "quoted", part'], [2, "plain", "y" * 9 + "\n\n" + "z" * 50], [3, "last", "w"]]
        write(tmp_path / f"{k:03}.csv", records)
    read = postings.read_postings(spark, str(tmp_path), None)
    assert read.rdd.getNumPartitions() > 300
    assert rows(read) == rows(plain(spark, str(tmp_path)))
    assert read.count() == 600


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_fields(spark, tiny_splits, tmp_path, end):
    rng = random.Random(3)
    pieces = ["a", "bé", " ", ",", '"', '""', "\n", "\r\n", "\n\n", "longer words here", "5\" pipe", "x" * 60]
    for k in range(4):
        make = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))
        write(tmp_path / f"{k}.csv", [[i, make(), make()] for i in range(25)], end)
    read = postings.read_postings(spark, str(tmp_path))
    assert rows(read) == rows(plain(spark, str(tmp_path), postings.POSTING_SCHEMA))
    assert read.count() == 100


def test_quotes_inside_unquoted_fields_and_blank_lines(spark, tiny_splits, tmp_path):
    text = "job_id,title,description\n1,5\" pipe,a\n\n2,\"q\nr\",it\"s\n" + "3,b,c\n" * 60 + '4,"he said ""no""\nand left",end'
    (tmp_path / "a.csv").write_text(text)
    read = postings.read_postings(spark, str(tmp_path), None)
    assert rows(read) == rows(plain(spark, str(tmp_path)))
    assert read.filter("title = '5\" pipe'").count() == 1


def test_rows_are_numbered_in_file_order(spark, tiny_splits, tmp_path):
    write(tmp_path / "a.csv", [[f"t{i}\n{'x' * (i % 37)}", f"d{i}"] for i in range(60)], header=["Job Title", "Job Description"])
    found = postings.import_foreign_csv(spark, str(tmp_path))
    assert [(r.job_id, r.description) for r in found.orderBy("job_id").collect()] == [(i + 1, f"d{i}") for i in range(60)]


def test_other_headers_and_short_rows_fail(spark, tiny_splits, tmp_path):
    (tmp_path / "a").mkdir()
    write(tmp_path / "a" / "1.csv", [[i, "t", "d" * 50] for i in range(9)])
    write(tmp_path / "a" / "2.csv", [[i, "t", "d" * 50] for i in range(9)], header=["job_id", "description", "title"])
    with pytest.raises(ValueError, match="different headers"):
        postings.read_postings(spark, str(tmp_path / "a"))
    (tmp_path / "b.csv").write_text("job_id,title,description\n" + "1,a,b\n" * 50 + "2,only\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        postings.read_postings(spark, str(tmp_path / "b.csv")).collect()


@pytest.mark.parametrize(("line", "inside", "after"), [
    ("", False, False), ("", True, True), ('"a', False, True), ('a"', True, False), ('a""', True, True), ('a"""', True, False),
    ('a,"b","c', False, True), ('a"b,c', False, False), ('b",c,"d"', True, False), ('b",c"', True, False), ('"",""', False, False),
])
def test_state_after_a_line(line, inside, after):
    assert split_csv.inside_after(line, inside) == after
