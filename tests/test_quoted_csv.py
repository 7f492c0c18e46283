"""Csv with line breaks in cells: byte ranges against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from shelflens.config import Dataset
from shelflens.sources.quoted_csv import read_quoted, records
from shelflens.sources.readers import load_dataset
from tests.conftest import rows


def cell(rng):
    text = "".join(rng.choice(["a", "é", " ", ",", '"', "\n", "b", "7"]) for _ in range(rng.choice([0, 1, 3, 12])))
    return '"' + text.replace('"', '""') + '"' if set(text) & set(',"\n') or rng.random() < 0.3 else text


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(size)) for k in before]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size, ending", [(64, "\n"), (301, "\n"), (7, "\n"), (97, "\r\n")])
def test_like_the_reader_of_whole_files(spark, tmp_path, small_ranges, size, ending):
    rng = random.Random(size)
    for name in "ab":
        body = [["id", "x y", "z"]] + [[f"{name}{i}", cell(rng), cell(rng)] for i in range(40)]
        text = ending.join(",".join(r) for r in body) + rng.choice(["", ending])
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
    norm = lambda df: df.select("id", *[F.replace(F.coalesce(c, F.lit("")), F.lit("\r\n"), F.lit("\n")) for c in ("`x y`", "z")])
    want = rows(norm(whole))
    small_ranges(size)
    found = read_quoted(spark, str(tmp_path))
    assert found.columns == whole.columns and rows(norm(found)) == want
    assert records(spark, str(tmp_path)).filter("first").count() == 2
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4


def test_a_cell_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, more" for i in range(200))
    (tmp_path / "a.csv").write_text(f'id,v\n1,"{long}"\n2,x\n3,"\n"\n')
    small_ranges(50)
    assert sorted(map(tuple, read_quoted(spark, str(tmp_path)).collect())) == [("1", long), ("2", "x"), ("3", "\n")]


def test_bad_records_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v,w\n1,x,5\n2,"a\nb"\n3,x,6,more\n\n4,"open,7\n5,y,8\n')
    data = Dataset("a.csv", line_breaks=True, bad_records="bad", types={"w": "long"})
    found = {r.id: (r.v, r.w, r.bad) for r in load_dataset(spark, "d", str(tmp_path), {"d": data}).collect()}
    assert found["1"] == ("x", 5, None) and found["2"] == ("a\nb", None, '2,"a\nb"') and found["3"][2] == "3,x,6,more"
    assert set(found) == {"1", "2", "3", "4"} and found["4"][2] == '4,"open,7\n5,y,8'
    without = load_dataset(spark, "d", str(tmp_path), {"d": Dataset("a.csv", line_breaks=True)})
    assert without.columns == ["id", "v", "w"] and without.count() == 4
    with pytest.raises(ValueError):
        load_dataset(spark, "d", str(tmp_path), {"d": Dataset("a.csv", bad_records="bad")})


def test_other_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "b.csv").write_text("v,id\n1,x\n")
    with pytest.raises(Exception, match="other columns"):
        read_quoted(spark, str(tmp_path)).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n")
    assert read_quoted(spark, str(tmp_path)).columns == ["id", "v"] and read_quoted(spark, str(tmp_path)).count() == 0
