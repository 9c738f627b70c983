"""CSV records with line breaks, read in small ranges, against Python's csv module."""

import csv
import io
import random

import pyarrow as pa
import pytest

from rowmill.sources.csv import read_csv
from rowmill.sources.csv_records import _bytes, _records, ends_inside, file_lines, ranges_inside, starts_inside

CELLS = ["", "a", "b c", "two\nlines", 'say "hi"', '"', "x,y", "\n\n", 'end"\n', "long " * 60, "ü\né", "1"]


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    yield
    for k, value in old.items():
        spark.conf.set(k, value)


def written(path, rows, line_end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=line_end, quoting=quoting).writerows(rows)


def random_rows(seed, n=150):
    draw = random.Random(seed)
    return [["id", "first", "second"]] + [[str(i), draw.choice(CELLS), draw.choice(CELLS)] for i in range(n)]


@pytest.mark.parametrize("line_end,quoting", [("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_ALL)])
def test_records_over_many_ranges(spark, tmp_path, small_ranges, line_end, quoting):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = random_rows(1)
    written(folder / "a.csv", rows, line_end, quoting)
    written(folder / "b.csv", [rows[0], *[["b" + r[0], *r[1:]] for r in rows[1:60]]], line_end, quoting)
    lines = file_lines(spark, str(folder))
    assert lines.select("place").distinct().count() > 5
    assert ranges_inside(lines)
    got = read_csv(spark, str(folder), null_texts=[]).collect()
    want = rows[1:] + [["b" + r[0], *r[1:]] for r in rows[1:60]]
    assert sorted((r.id, r.first or "", r.second or "") for r in got) == sorted(map(tuple, want))


def test_equals_one_task_a_file(spark, tmp_path, small_ranges):
    written(tmp_path / "a.csv", random_rows(2))
    split, whole = (read_csv(spark, str(tmp_path / "a.csv"), multi_line=m) for m in (False, True))
    assert split.schema == whole.schema and split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


def test_one_record_over_many_ranges(spark, tmp_path, small_ranges):
    cell = "\n".join(f"line {i}" for i in range(400))
    written(tmp_path / "a.csv", [["id", "x"], ["1", cell], ["2", "b"], ["3", cell]])
    assert {r.id: r.x for r in read_csv(spark, str(tmp_path / "a.csv")).collect()} == {1: cell, 2: "b", 3: cell}


def test_stray_quotes_and_schema(spark, tmp_path, small_ranges):
    text = 'id,x\n1,5" disk\n2,"a\nb"\n3,6" disk\n4,"c ""d""\n"\n\n' + "".join(f'{i},plain {i}"\n' for i in range(5, 60))
    (tmp_path / "a.csv").write_text(text)
    rows = {r.id: r.x for r in read_csv(spark, str(tmp_path / "a.csv"), "id INT, x STRING").collect()}
    assert len(rows) == 59 and rows[1] == '5" disk' and rows[2] == "a\nb" and rows[4] == 'c "d"\n' and rows[59] == 'plain 59"'


def test_open_at_the_end_and_header_over_lines(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('id,"two\nlines"\n1,a\n2,"never closed\nmore')
    rows = read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert rows[0].asDict().keys() == {"id", "two\nlines"}
    assert sorted((r[0], r[1].split("\n")[0]) for r in rows) == [(1, "a"), (2, "never closed")] or len(rows) == 2


def test_small_ranges_share_tasks(spark, tmp_path, small_ranges):
    written(tmp_path / "a.csv", random_rows(4, 900))
    lines = file_lines(spark, str(tmp_path / "a.csv"))
    least = 4 * spark.sparkContext.defaultParallelism
    assert lines.select("place").distinct().count() > 2 * least and lines.rdd.getNumPartitions() == least
    assert _bytes("256k") == 256 << 10 and _bytes("128MB") == 128 << 20 and _bytes("134217728b") == 134217728 and _bytes("900") == 900


def test_records_are_handed_over_together():
    """Records over several lines, and few lines without quotes between them, are one batch; many such lines are one of their own."""
    texts = ["id,x"] + [line for i in range(500) for line in (f'{i},"a', "", 'b"', f"{i},c")] + ["d,e"] * 100 + ['f,"open', "g"]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts)), pa.array([0] * len(texts)), pa.array(texts)], ["file", "place", "line"])
    found = [b.to_pydict() for b in _records(iter([batch]), {})]
    assert [len(b["record"]) for b in found] == [1001, 100, 1] or [len(b["record"]) for b in found] == [1000, 101, 1]
    kinds = [k for b in found for k in b["kind"]]
    assert kinds == ["header"] + ["whole"] * 1100 + ["open"]
    records = [r for b in found for r in b["record"]]
    assert records[1:4] == ['0,"a\n\nb"', "0,c", '1,"a\n\nb"'] and records[-1] == 'f,"open\ng'


def test_states_at_the_starts_of_ranges():
    turned = {1: [10, 20, 20, 40]}
    assert [starts_inside(turned, 1, place) for place in (0, 10, 20, 30, 40, 50)] == [False, False, True, True, True, False]
    assert not starts_inside(turned, 2, 50)


def test_state_of_lines():
    draw = random.Random(3)
    for _ in range(300):
        line = "".join(draw.choice('",a') for _ in range(draw.randrange(9)))
        # a line starts inside if an open quote lies before it; a later line tells whether it ends inside
        records = list(csv.reader(io.StringIO(line + '\nz')))
        if '""' not in line and not any(c == '"' and p not in ',"' for p, c in zip("," + line, line)):
            assert ends_inside(line, False) == (len(records) == 1 and line != ""), line
