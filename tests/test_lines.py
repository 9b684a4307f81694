import gzip
import json

import pytest

from textloom.sources import jsonl
from textloom.sources import lines as op


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {k} {'x' * (k * 7 % 90)}\n" + "\n" * (k % 3 == 0) for k in range(400)), newline="")
    (tmp_path / "b.txt").write_text("".join(f"{k}\r\n" for k in range(300)) + "no end", newline="")
    (tmp_path / "c.txt").write_text("one\rtwo\rthree", newline="")
    (tmp_path / "d.txt").write_text("", newline="")
    (tmp_path / "e.txt").write_text("y" * 5000 + "\n\n\nlast\n", newline="")
    with gzip.open(tmp_path / "f.txt.gz", "wt") as out:
        out.write("packed\nlines\n")
    return tmp_path


def plain(folder):
    return {f.name: [line.removesuffix("\n") for line in (gzip.open(f, "rt") if f.suffix == ".gz" else open(f))] for f in sorted(folder.iterdir())}  # noqa: SIM115


def test_numbers_over_many_splits(spark, folder, small_splits):
    found = op.numbered_lines(spark, f"file://{folder}")
    assert found.rdd.getNumPartitions() > 20
    got = {}
    for r in found.collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.line_number, r.line))
    assert {name: [x for _, x in sorted(own)] for name, own in got.items()} == {k: v for k, v in plain(folder).items() if v}
    assert all(sorted(n for n, _ in own) == list(range(1, len(own) + 1)) for own in got.values())


def test_numbers_equal_whole_files(spark, folder, small_splits):
    (folder / "c.txt").unlink()
    whole = {(r.file, r.line_number, r.line) for r in jsonl.numbered_lines(spark, f"file://{folder}").collect() if r.line}
    assert whole == {(r.file, r.line_number, r.line) for r in op.numbered_lines(spark, f"file://{folder}").collect() if r.line}


def test_numbers_across_files(spark, folder, small_splits):
    wanted = [line for own in plain(folder).values() for line in own]
    assert [r.line for r in op.numbered_lines(spark, f"file://{folder}", across=True).orderBy("line_number").collect()] == wanted
    assert op.numbered_lines(spark, f"file://{folder}", across=True, glob="*.gz").count() == 2


def test_no_line_is_shuffled(spark, folder, small_splits):
    plan = op.numbered_lines(spark, f"file://{folder}")._jdf.queryExecution().executedPlan().toString()
    assert "value#" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_errors_by_line(spark, tmp_path):
    good = {"instruction": "do", "input": "x", "output": "y"}
    rows = [good, {**good, "extra": [1]}, "", {**good, "input": None}, {**good, "output": "  "}, {"instruction": "a"}, "nonsense", "[1, 2]", "3", {**good, "output": 4}, {**good, "output": "```sh"}, {**good, "instruction": {"a": 1}}, good]
    (tmp_path / "x.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    (tmp_path / "y.jsonl").write_text(json.dumps(good) + "\n")
    checked = op.with_repeats(op.checked_lines(op.numbered_lines(spark, f"file://{tmp_path}")))
    found = {(r.file[-7], r.line_number): r.errors for r in op.errors_of(checked).collect()}
    twice = next(e for e in found["x", 2] if e.startswith("Duplicate content (hash: "))
    assert found == {
        ("x", 1): [], ("x", 2): [twice], ("x", 4): ["Empty field 'input'"], ("x", 5): ["Empty field 'output'"], ("x", 6): ["Missing field 'input'", "Missing field 'output'"],
        ("x", 7): ["Invalid JSON"], ("x", 8): ["Invalid JSON"], ("x", 9): ["Invalid JSON"], ("x", 10): ["Field 'output' is no text"], ("x", 11): ["Contains markdown code fences"],
        ("x", 12): ["Field 'instruction' is no text"], ("x", 13): [twice], ("y", 1): [],
    }
    assert [tuple(r) for r in op.folder_summary(checked, jsonl.parent_folder("file")).collect()] == [(tmp_path.name, 2, 13, 10, 2)]


def test_no_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("")
    assert op.errors_of(op.with_repeats(op.checked_lines(op.numbered_lines(spark, f"file://{tmp_path}")))).count() == 0


def test_numbers_and_nulls_count_in_the_hash(spark, tmp_path):
    rows = [{"instruction": 17, "input": None, "output": "x"}, {"instruction": "17", "output": "x"}, {"instruction": "1", "input": "7", "output": "x"}, {"instruction": "18", "output": "x"}]
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    checked = op.with_repeats(op.checked_lines(op.numbered_lines(spark, f"file://{tmp_path}")))
    assert [r.repeats for r in checked.orderBy("line_number").collect()] == [False, True, True, False]
