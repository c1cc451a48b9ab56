import csv
import io
import random

import pytest

from tandem.sources.csv_splits import INSIDE, OUTSIDE, CsvSplits, after
from tandem.sources.parallel import load_dictionaries, load_numbered_dictionaries, read_dictionary


@pytest.fixture
def splits_of(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def hold(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield hold
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_states_behind_lines():
    assert after('a,b,"c, d"', OUTSIDE) == OUTSIDE
    assert after('a,"b', OUTSIDE) == INSIDE
    assert after('a,"b""', OUTSIDE) == INSIDE
    assert after('5" tall,6" wide', OUTSIDE) == OUTSIDE
    assert after('"a"b,"', OUTSIDE) == INSIDE
    assert after("", OUTSIDE) == OUTSIDE and after("", INSIDE) == INSIDE
    assert after('end",x', INSIDE) == OUTSIDE
    assert after('end"', INSIDE) == OUTSIDE
    assert after('end",', INSIDE) == OUTSIDE
    assert after('end","more', INSIDE) == INSIDE
    assert after('said ""no""', INSIDE) == INSIDE
    assert after('x"y",z', INSIDE) == OUTSIDE


def written(rows, header, ending="\n"):
    text = io.StringIO(newline="")
    writer = csv.writer(text, lineterminator=ending)
    writer.writerow(header)
    writer.writerows(rows)
    return text.getvalue()


def rows_of(seed, n):
    rng = random.Random(seed)

    def cell():
        parts = ["word", ",", '"', "\n", "\r\n", " ", "é", '""', "5", "\n\n"]
        return "".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 12]))) or "x"

    return [[cell(), f"{i}", cell()] for i in range(n)]


@pytest.mark.parametrize("size, ending", [(64, "\n"), (500, "\r\n"), (1 << 20, "\n")])
def test_records_cross_splits(spark, files, splits_of, size, ending):
    splits_of(size)
    contents = {f"{i}.csv": rows_of(i, n) for i, n in enumerate([300, 1, 0, 40])}
    root = files({f"d/{name}": written(rows, ["a", "n", "b"], ending) for name, rows in contents.items()} | {"d/z.csv": ""})
    found = load_numbered_dictionaries(spark, [f"{root}/d"], multi_line=True)
    expected = [row for name in sorted(contents) for row in contents[name]]
    assert [(r.line_no, [r.a, r.n, r.b]) for r in sorted(found.collect(), key=lambda r: r.line_no)] == list(enumerate(expected))
    if size < 1000:
        scan = CsvSplits(spark, [f"{root}/d"]).blocks
        assert scan.filter("path LIKE '%/0.csv'").count() > 5 and not scan.filter("inside = 1").isEmpty()


def test_cells_wider_than_splits_and_an_open_end(spark, files, splits_of):
    splits_of(64)
    long = "\n".join(f"line {i}, with \"quotes\"" for i in range(200))
    root = files({"a.csv": written([[long, "1"], ["x", "2"], [long, "3"]], ["text", "n"]) + '"never closed\nat all,4\n'})
    found = {r.n: r.text for r in read_dictionary(spark, f"{root}/a.csv", multi_line=True).collect()}
    assert found == {"1": long, "2": "x", "3": long, None: "never closed\nat all,4"}


def test_wide_headers(spark, files, splits_of):
    splits_of(256)
    names = [f"column {i}" + "\n" * (i % 2) for i in range(40)]
    root = files({"a.csv": written([[str(i) for i in range(40)]], names), "b.csv": "column 38,other\nleft,right\n"})
    found = load_dictionaries(spark, [f"{root}/b.csv", f"{root}/a.csv"], multi_line=True)
    assert found.columns == ["column 38", "other"] + [name for name in names if name != "column 38"]
    rows = sorted(found.collect(), key=lambda r: r.other or "")
    assert [r["column 38"] for r in rows] == ["38", "left"] and rows[0][names[7]] == "7" and rows[1][names[7]] is None
    many = [f"n{i}" for i in range(20_000)]
    root = files({"c.csv": written([many], many)}, "in2")
    assert read_dictionary(spark, f"{root}/c.csv", multi_line=False).columns == many


def test_stray_quotes_blank_lines_and_short_records(spark, files, splits_of):
    splits_of(32)
    text = '\ufeffa,b\n5" tall,x\n\n"q"z,"y"\r\n\r\nonly\n1,2,3\n"",\n'
    root = files({"a.csv": text})
    found = load_numbered_dictionaries(spark, [f"{root}/a.csv"], multi_line=True)
    assert sorted((r.line_no, r.a, r.b) for r in found.collect()) == [
        (0, '5" tall', "x"), (1, '"q"z', "y"), (2, "only", None), (3, "1", "2"), (4, None, None)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_folders_of_empty_files(spark, files, multi_line):
    root = files({"d/a.csv": "", "d/b.csv": ""})
    assert read_dictionary(spark, f"{root}/d", multi_line=multi_line).count() == 0
    assert load_numbered_dictionaries(spark, [f"{root}/d"], multi_line=multi_line).count() == 0
    only = files({"d/a.csv": "x,y\n"}, "in2")
    found = read_dictionary(spark, f"{only}/d", multi_line=multi_line)
    assert found.columns == ["x", "y"] and found.count() == 0


def test_a_name_that_stands_twice_is_refused(spark, files):
    with pytest.raises(ValueError, match="twice"):
        CsvSplits(spark, [files({"a.csv": "x,x\n1,2\n"})])
