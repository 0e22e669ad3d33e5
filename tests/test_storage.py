import csv
import random
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import types as T

from rollmatch.sources import logs, sinks, sqltables, tabs, versions
from rollmatch.sources.appendlog import AppendLog, read_appended


def test_tab_round_trip_with_awkward_cells(spark, table, tmp_path):
    cells = ['plain', 'a,b', 'say "hi"', 'two\nlines', ' padded ', 'back\\slash', '', None, 'nan']
    df = table([(i, c, str(i)) for i, c in enumerate(cells)], "at int, v string, k string").repartition(3)
    path = str(tmp_path / "tab")
    sinks.write_tab(df, path, order="at")
    back = tabs.read_tab(spark, path)
    got = {int(r["k"]): (r["_ord"], r["v"]) for r in back.collect()}
    assert got == {i: (i, None if c in ("", None, "nan") else c) for i, c in enumerate(cells)}


def test_empty_tab(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert tabs.read_tab(spark, str(tmp_path / "empty.csv")).columns == []


def test_typed_csv_and_missing_source(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,v,w\n1,NA,2.5\n,None,oops\n3,text,\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("w", T.DoubleType())])
    assert rows(tabs.read_optional(spark, str(tmp_path / "x.csv"), schema)) == [(1, None, 2.5), (3, "text", None), (None, None, None)]
    missing = tabs.read_optional(spark, str(tmp_path / "y.csv"), schema, order="_ord")
    assert missing.columns == ["_ord", "id", "v", "w"] and missing.count() == 0


def test_snapshots_skip_other_names_and_half_written_ones(spark, tmp_path):
    base = str(tmp_path / "base")
    assert sinks.snapshot_path(spark, base) is None
    for day in (1, 3, 2):
        sinks.write_snapshot(spark.range(day), base, at=datetime(2024, 5, day, 1, 2, 3))
    for name in ("results-20250101", "results-99999999_000000", "other-20250101_000000", "results-20250101_000000"):
        (tmp_path / "base" / name).mkdir()
    assert sinks.read_snapshot(spark, base).count() == 3
    assert sinks.read_snapshot(spark, base, version="20240502_010203").count() == 2
    with pytest.raises(ValueError):
        sinks.snapshot_path(spark, base, version="20200101_000000")
    with pytest.raises(ValueError):
        sinks.read_snapshot(spark, base, prefix="index-")


def test_replace_table_may_read_itself(spark, tmp_path):
    base = str(tmp_path / "t")
    sinks.replace_table(spark.range(5), base)
    for _ in range(2):
        current = sinks.read_table(spark, base)
        sinks.replace_table(current.selectExpr("id + 1 AS id").where("id > 2"), base)
    # 0..4 becomes 3, 4, 5 and then 4, 5, 6.
    assert rows(sinks.read_table(spark, base)) == [(4,), (5,), (6,)]


def test_append_by_position_and_its_guard(spark, table, tmp_path):
    path = str(tmp_path / "p")
    sinks.append_rows(table([("a", 1)], "k string, v int"), path)
    sinks.append_rows(table([("b", 2)], "other string, names int"), path)
    sinks.append_rows(table([("c",)], "short string"), path)
    sinks.append_rows(table([(4, "d")], "v int, k string"), path, by_position=False)
    assert rows(read_appended(spark, path)) == [("a", 1), ("b", 2), ("c", None), ("d", 4)]
    with pytest.raises(ValueError):
        sinks.append_rows(table([("a", 1, 2)], "a string, b int, c int"), path)


def test_strict_append_twice_adds_nothing(spark, table, tmp_path):
    path = str(tmp_path / "s")
    df = table([(1, None, "x"), (2, "b", "y")], "id int, name string, extra string")
    for _ in range(2):
        sinks.strict_append(df, path, ["id", "name", "city"])
    assert rows(read_appended(spark, path)) == [("1", "", ""), ("2", "b", "")]


def test_sql_tables_and_listing(spark, table):
    df = table([(1, 35, "Male"), (2, None, "Female")], "sp_id int, age int, gender string")
    sqltables.publish_view(df, "people_mock")
    assert "people_mock" in sqltables.table_names(spark)
    assert sqltables.column_names(spark, "people_mock") == ["sp_id", "age", "gender"]
    assert rows(sqltables.run_sql(spark, "SELECT age FROM people_mock WHERE gender = :g", {"g": "Male"})) == [(35,)]
    assert rows(sqltables.records(spark, "people_mock"))[1][0] == '{"sp_id":2,"age":null,"gender":"Female"}'
    sqltables.save_sql_table(df, "people_saved")
    sqltables.save_sql_table(df.where("sp_id = 1"), "people_saved")
    assert spark.table("people_saved").count() == 1


def test_log_scan(spark, tmp_path):
    (tmp_path / "bad.log").write_text("start\nall fine\n  An ERROR here \nTraceback later\n")
    (tmp_path / "good.log").write_text("start\ndone\n")
    got = {r["file"].rsplit("/", 1)[1]: (r["has_error"], r["first_line"]) for r in logs.scan_logs(spark, str(tmp_path)).collect()}
    assert got == {"bad.log": (True, "An ERROR here"), "good.log": (False, None)}


def test_cut_tables_live_in_the_shared_folder_until_cleared(spark):
    from rollmatch.session import clear_scratch, cut, shared_dir

    kept = cut(spark.range(7))
    assert kept.count() == 7
    assert kept.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark).removeprefix("file:"))
    clear_scratch(spark)
    assert not tabs.path_exists(spark, kept.inputFiles()[0])


def test_a_tab_is_replaced_whole_or_not_at_all(spark, table, tmp_path):
    base = str(tmp_path / "tab")
    sinks.write_tab(table([("1", "a"), ("2", "b")], "id string, v string"), base)
    sinks.write_tab(tabs.read_tab(spark, base, order=None).selectExpr("id", "concat(v, '+') AS v"), base)
    now = tabs.read_tab(spark, base, order=None)
    with pytest.raises(Exception, match="stopped"):
        sinks.write_tab(now.selectExpr("id", "raise_error('stopped') AS v"), base)
    assert rows(tabs.read_tab(spark, base, order=None)) == [("1", "a+"), ("2", "b+")]
    sinks.write_tab(now.limit(1), base)
    assert tabs.read_tab(spark, base, order=None).count() == 1 and len(versions.stamped(spark, base, "v-")) == 3
    versions.drop_old_versions(spark, base, keep=1)
    assert tabs.read_tab(spark, base, order=None).count() == 1 and len(versions.stamped(spark, base, "v-")) == 1
    # An export made elsewhere has no versions and is read as it is.
    (tmp_path / "plain.csv").write_text("id,v\n7,z\n")
    assert rows(tabs.read_tab(spark, str(tmp_path / "plain.csv"), order=None)) == [("7", "z")]


def test_append_log_takes_a_batch_once_and_never_two_of_one_state(spark, table, tmp_path):
    log = AppendLog(spark, str(tmp_path / "log"))
    assert log.read() is None and log.entries() == []
    schema, asked = "id long, v string", []

    def unseen(new):
        def rows_of(held):
            asked.append(held is not None and held.count())
            return new if held is None else new.join(held, "id", "left_anti")
        return rows_of

    first = log.append(unseen(table([(1, "a")], schema)), "b1")
    assert log.append(unseen(table([(9, "z")], schema)), "b1") == first and log.read().count() == 1

    def overtaken(held):
        if len(log.entries()) == 1:  # another writer adds a key of ours in between
            log.append(unseen(table([(2, "theirs")], schema)), "other")
        return unseen(table([(1, "x"), (2, "ours"), (3, "c")], schema))(held)

    entry = log.append(overtaken, "b2")
    assert rows(log.read()) == [(1, "a"), (2, "theirs"), (3, "c")] and asked == [False, 1, 1, 2]
    assert rows(log.read([entry])) == [(3, "c")] and rows(log.before(entry)) == [(1, "a"), (2, "theirs")]
    # A writer that died after taking its number leaves a gap; data without an entry is never read.
    (tmp_path / "log" / "log" / f"{entry.number + 1:012d}").write_text("")
    table([(8, "lost")], schema).write.parquet(str(tmp_path / "log" / "data" / "orphan"))
    assert log.read().count() == 3
    assert log.append(unseen(table([(4, "d")], schema)), "b3").number == entry.number + 2
    with pytest.raises(ValueError):
        log.append(lambda held: table([("x",)], "other string"), "b4")


def test_stopped_write_of_a_batch_is_not_read(spark, table, tmp_path):
    log = AppendLog(spark, str(tmp_path / "log"))
    with pytest.raises(Exception, match="stopped"):
        log.append(lambda held: table([(1,)], "id long").selectExpr("id", "raise_error('stopped') AS v"), "b")
    assert log.read() is None
    log.append(lambda held: table([(1, "a")], "id long, v string"), "b")
    assert log.read().count() == 1


@pytest.mark.parametrize("limit", [64, 700, 1 << 20])
def test_files_with_line_breaks_in_cells_are_split(spark, table, tmp_path, limit):
    """Splits begin anywhere: inside quotes, at a doubled quote, in a cell that holds what looks like records."""
    rng = random.Random(limit)
    odd = ['', 'plain', 'a,b', '"', '""', 'two\nlines', '\n\n', '1,2\n3,4\n"5",6', 'say "hi"\nthen', ' pad ', 'x' * 300, '\r\nz', 'é,\n漢']
    want = []
    for part in range(3):
        data = [[str(len(want) + i), rng.choice(odd), rng.choice(odd)] for i in range(40 * part)]
        with open(tmp_path / f"part-{part}.csv", "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f, lineterminator="\r\n" if part == 2 else "\n")
            writer.writerows([["n", "a", "b\nof two lines"], *data])
            f.write("\n" if part == 1 else "")
        want += [(int(n), n, a or None, b or None) for n, a, b in data]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(limit))
    try:
        got = tabs.read_tab(spark, str(tmp_path))
        assert got.columns == ["n", "a", "b\nof two lines", "_ord"]
        assert sorted((r[3], r[0], r[1], r[2]) for r in got.collect()) == want
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert limit > 1000 or tasks > 3  # several tasks a file


def test_lines_of_a_tab_are_not_shuffled(spark, tmp_path):
    """Only lines of cells that hold line breaks leave the task that read them; the rows are those of one reader for all."""
    cells = [str(i) if i % 40 else f'{i}\n\n""x' for i in range(400)]
    (tmp_path / "a.csv").write_text("id,v,w\n" + "".join(f'{i},"{c}",{w}\n' for i, (c, w) in enumerate(zip(cells, ['nan', '""', '', 'w'] * 100))))
    (tmp_path / "b.csv").write_text("id,v,w\r\n400,y,z\r\n")
    with_splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        tab = tabs.read_tab(spark, str(tmp_path))
        plan = tab._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(tuple(r) for r in tab.select("_ord", "id", "v", "w").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_splits)
    words = [None, None, None, "w"]
    assert got == [(i, str(i), c.replace('""', '"'), words[i % 4]) for i, c in enumerate(cells)] + [(400, "400", "y", "z")]
    # Windows run over one row per split, never over lines.
    assert not any("line#" in step for step in plan.splitlines() if "Window [" in step)
