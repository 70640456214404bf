"""Splitting raw logs by day and reading the result back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from authwatch.operators import parse as ps
from authwatch.operators import split as sp
from authwatch.sources import logs


def write_log(path, n):
    """Days interleave, so every split of the file holds all of them."""
    lines = [f"Dec {9 + i % 3:2d} 00:00:00 host sshd[1]: line {i}" for i in range(n)]
    path.write_text("\n".join(lines + ["no date here", ""]) + "\n")
    return lines


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_order_survives_many_splits(spark, tmp_path, small_splits):
    lines = write_log(tmp_path / "SSH.log", 2000)
    read = logs.read_logs(spark, str(tmp_path / "*.log"))
    assert read.rdd.getNumPartitions() > 5
    got = [r["message"] for r in read.orderBy(*sp.LINE_ORDER).collect()]
    assert got == lines + ["no date here", ""]


@pytest.mark.parametrize("buckets", [1, 3, 256])
def test_cap_keeps_the_first_lines_of_each_day(spark, tmp_path, small_splits, buckets):
    lines = write_log(tmp_path / "SSH.log", 2000)
    dated = sp.dated_lines(logs.read_logs(spark, str(tmp_path / "*.log")), 2024)
    got = sp.first_n_per_group(dated, "file_name", n=100, buckets=buckets).collect()
    for day in ("09", "10", "11"):
        want = [x for x in lines if x[4:6].strip() == day.lstrip("0")][:100]
        mine = sorted((r["block_start"], r["line_no"], r["message"]) for r in got
                      if r["file_name"] == f"ssh-202412{day}.log")
        assert [m[2] for m in mine] == want
    assert sum(r["file_name"] is None for r in got) == 2


def test_split_files_read_back_as_logs(spark, tmp_path):
    lines = write_log(tmp_path / "SSH.log", 30)
    out = str(tmp_path / "days")
    sp.split_by_date(logs.read_logs(spark, str(tmp_path / "SSH.log")), 2024, out)
    back = ps.source_file_name(logs.read_logs(spark, f"{out}/file_name=ssh-*.log"))
    got = {(r["source_file"], r["message"]) for r in back.collect()}
    assert got == {(f"202412{x[4:6].strip():0>2}", x) for x in lines}
    assert all(r["source_path"] == f"{out}/ssh-{r['source_file']}.log" for r in back.collect())


def test_capped_split_and_its_counts(spark, tmp_path):
    write_log(tmp_path / "SSH.log", 30)
    raw = logs.read_logs(spark, str(tmp_path / "SSH.log"))
    out = str(tmp_path / "days")
    sp.split_by_date_capped(raw, 2024, out, max_rows=4)
    counts = {r["file_name"]: r["n_lines"]
              for r in sp.split_counts(spark.read.text(out)).collect()}
    assert counts == {"ssh-20241209.log": 4, "ssh-20241210.log": 4, "ssh-20241211.log": 4, None: 2}


def test_day_is_padded_and_month_is_a_number(spark):
    df = spark.createDataFrame([("Jan  1 x y",), ("Feb 28 x",), ("Dec 31 x",), ("Foo 31 x",),
                                (None,)], "message string")
    assert [r["file_name"] for r in sp.dated_lines(df, "2024").collect()] == [
        "ssh-20240101.log", "ssh-20240228.log", "ssh-20241231.log", None, None]


@pytest.mark.parametrize("name", ["a b", "100%", "c++", "d%20e", "é日"])
def test_source_path_is_plain(spark, tmp_path, name):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "ssh-20240101.log").write_text("line\n")
    # A glob has no meaning for these names but for the backslash-free ones here.
    (row,) = logs.read_logs(spark, str(tmp_path / "*" / "*.log")).collect()
    assert row["source_path"] == f"{folder}/ssh-20240101.log"


def test_what_a_cap_leaves_out_is_told(spark, tmp_path):
    write_log(tmp_path / "SSH.log", 30)
    dated = sp.dated_lines(logs.read_logs(spark, str(tmp_path / "SSH.log")), 2024)
    got = {r["file_name"]: r["n_left_out"] for r in sp.split_left_out(dated, 4).collect()}
    assert got == {"ssh-20241209.log": 6, "ssh-20241210.log": 6, "ssh-20241211.log": 6, None: 0}


def test_dump_is_capped_and_ordered(events):
    rows = [(f"2024-01-01 00:00:{n:02d}", None, "etc", "INFO") for n in (5, 3, 9)]
    got = sp.capped_dump(events(rows), 2).select(F.second("event_time").alias("s")).collect()
    assert [r["s"] for r in got] == [3, 5]


def concatenated(folder):
    return [x for part in sorted(folder.iterdir()) if part.name.startswith("part-")
            for x in part.read_text().splitlines()]


def test_parts_of_a_day_by_name_are_its_log(spark, tmp_path, small_splits):
    lines = write_log(tmp_path / "SSH.log", 3000)
    read = logs.read_logs(spark, str(tmp_path / "SSH.log"))
    sp.write_split(sp.dated_lines(read, 2024), str(tmp_path / "days"), part_bytes=10_000)
    folders = {f.name: f for f in (tmp_path / "days").iterdir() if f.is_dir()}
    for day in ("09", "10", "11"):
        folder = folders[f"file_name=ssh-202412{day}.log"]
        assert concatenated(folder) == [x for x in lines if x[4:6].strip() == day.lstrip("0")]
        assert len([x for x in folder.iterdir() if x.name.startswith("part-")]) > 1
    assert concatenated(folders["file_name=__HIVE_DEFAULT_PARTITION__"]) == ["no date here", ""]
    sp.split_by_date_capped(read, 2024, str(tmp_path / "capped"), 7)
    assert concatenated(tmp_path / "capped" / "file_name=ssh-20241209.log") == lines[0:21:3]


def test_line_numbers_in_many_splits(spark, tmp_path, small_splits):
    wanted = {}
    for name, n in (("a", 1500), ("b", 3), ("c", 700)):
        write_log(tmp_path / f"{name}.log", n)
        wanted[name] = (tmp_path / f"{name}.log").read_text().split("\n")[:-1]
    (tmp_path / "empty.log").write_text("")
    numbered = logs.read_numbered_logs(spark, str(tmp_path / "*.log"))
    assert spark.read.text(str(tmp_path / "*.log")).rdd.getNumPartitions() >= 8
    got = {}
    for row in numbered.collect():
        got.setdefault(row["source_path"].rpartition("/")[2][0], {})[row["line_number"]] = row["message"]
    assert {name: [rows[n] for n in range(1, len(rows) + 1)] for name, rows in got.items()} == wanted


def test_numbers_count_on_over_the_parts_of_a_day(spark, tmp_path, small_splits):
    lines = write_log(tmp_path / "SSH.log", 3000)
    read = logs.read_logs(spark, str(tmp_path / "SSH.log"))
    sp.write_split(sp.dated_lines(read, 2024), str(tmp_path / "days"), part_bytes=10_000)
    back = logs.read_numbered_logs(spark, str(tmp_path / "days" / "file_name=ssh-*.log"))
    got = [r["message"] for r in back.filter("source_path LIKE '%ssh-20241210.log'")
           .orderBy("line_number").collect()]
    assert got == lines[1::3]


def test_paths_are_made_out_per_split_and_lines_stay_in_place(spark, tmp_path):
    write_log(tmp_path / "a.log", 30)
    numbered = logs.read_numbered_logs(spark, str(tmp_path / "*.log"))
    text = numbered._jdf.queryExecution().optimizedPlan().toString()
    join = text[:text.index("Aggregate")]
    assert "Join" in join and "strategy=broadcast" in join and "url" not in join.lower()


def test_splits_of_a_large_folder_grow_with_it(spark, tmp_path, monkeypatch):
    from authwatch import catalog
    days = tmp_path / "days" / "file_name=ssh-20241209.log"
    days.mkdir(parents=True)
    lines = [f"Dec  9 10:00:00 line {n} " + "x" * 80 for n in range(3000)]
    (days / "part-00000.txt").write_text("\n".join(lines) + "\n")
    read, used = logs.read_numbered_logs, []

    def numbered(*args):
        used.append(int(spark.conf.get("spark.sql.files.maxPartitionBytes")))
        return read(*args)

    monkeypatch.setattr(catalog, "log_files", lambda *_: str(tmp_path / "days"))
    monkeypatch.setattr(catalog.logs, "read_numbered_logs", numbered)
    for most in (1000, 4):
        monkeypatch.setattr(catalog, "MOST_SPLITS", most)
        got = catalog.q_line_numbers(spark, "").orderBy("line_number").collect()
        assert [r["message"] for r in got] == lines
    size = (days / "part-00000.txt").stat().st_size
    assert used == [catalog.SPLIT_BYTES, size // 4]
