"""CSV with line breaks inside fields, block by block, against a reader of whole files."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources import records, tables

TEXTS = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "400")
    spark.conf.set(names[1], "1")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, seed, n, end="\n"):
    rng = random.Random(seed)
    pieces = ['"', ",", "\n", "é", "x y", "5\" pipe", '"",""', ",\n\"", "\n\n", "  ", "word" * 30]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 3, 8, 60 if i % 19 == 0 else 2])))
        rows.append([text or None, i, rng.choice(["z", '"', "a,b", "l\nm"])])
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["a", "b", "c"])
        writer.writerows(rows)
    return rows


def same(got, rows):
    assert sorted(((r.a, r.b, r.c) for r in got), key=lambda r: r[1]) == [tuple(r) for r in rows]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_records_across_blocks(small_blocks, tmp_path, seed, end):
    path = str(tmp_path / "x.csv")
    rows = write(path, seed, 300, end)
    assert small_blocks.read.text(path, lineSep="\n").select(F.spark_partition_id()).distinct().count() > 8
    same(tables.read_csv_typed(small_blocks, path, TEXTS, multi_line=True).collect(), rows)


def test_beyond_the_broadcast(small_blocks, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_BLOCKS", 0)
    rows = write(str(tmp_path / "x.csv"), 3, 200)
    same(tables.read_csv_typed(small_blocks, str(tmp_path), TEXTS, multi_line=True).collect(), rows)


def test_several_files_each_with_a_header(small_blocks, tmp_path):
    one, two = write(str(tmp_path / "1.csv"), 4, 90), write(str(tmp_path / "2.csv"), 5, 90)
    got = tables.read_csv_typed(small_blocks, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")], TEXTS, multi_line=True)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.a, r.b, r.c) for r in got.collect()), key=key) == sorted(map(tuple, one + two), key=key)


def test_a_field_of_many_blocks_and_a_header_across_lines(small_blocks, tmp_path):
    long = "\n".join(f'line {i} of "one" field, still' for i in range(200))
    with open(tmp_path / "x.csv", "w", newline="") as out:
        csv.writer(out).writerows([["a\n" + "h" * 900 + "\n", "b", "c"], [long, 1, "z"], ["last", 2, "y"]])
    got = tables.read_csv_typed(small_blocks, str(tmp_path / "x.csv"), TEXTS, multi_line=True)
    same(got.collect(), [(long, 1, "z"), ("last", 2, "y")])


def test_stray_and_open_quotes(small_blocks, tmp_path):
    lines = ['5" pipe,1,z', '"a\nb" c,2,z', '', '   ', '"x",3,"p\nq",surplus', 'open,4,"rest\nof it\n']
    (tmp_path / "x.csv").write_text("a,b,c\n" + "\n".join(lines))
    got = tables.read_csv_typed(small_blocks, str(tmp_path / "x.csv"), TEXTS, multi_line=True).collect()
    assert sorted((r.b, r.c) for r in got)[:2] == [(1, "z"), (2, "z")] and {r.b for r in got} == {1, 2, 4}
    bad = tables.skipped_lines(small_blocks, str(tmp_path / "x.csv"), TEXTS, multi_line=True).collect()
    assert [(r.b, r.c, r.surplus) for r in bad] == [(3, "p\nq", "surplus")]


def test_without_line_breaks_no_python(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n"p ""q""",1,"x, y"\n')
    (tmp_path / "empty.csv").write_text("")
    got = tables.read_csv_typed(spark, [str(tmp_path / "x.csv"), str(tmp_path / "empty.csv")], TEXTS, multi_line=True)
    assert [tuple(r) for r in got.collect()] == [('p "q"', 1, "x, y")]


def test_csv_tables_with_line_breaks(small_blocks, tmp_path):
    rows = write(str(tmp_path / "known.csv"), 7, 60)
    same(tables.load_csv_tables(small_blocks, str(tmp_path), {"known": TEXTS})["known_df"].collect(), rows)
