"""Whole jobs from tab to tab, stopped and started again."""

import pytest
from helpers import rows

from rollmatch.functions.columns import cols
from rollmatch.operators.order import ORDER
from rollmatch.plans import layouts as L
from rollmatch.plans import sheets
from rollmatch.plans.participants import roll_up_participants
from rollmatch.plans.stages import Stages
from rollmatch.queries import jobs
from rollmatch.session import short_methods
from rollmatch.sources.appendlog import AppendLog, read_appended
from rollmatch.sources.sinks import write_tab
from rollmatch.sources.tabs import read_tab
from rollmatch.sources.versions import stamped

CENTER = "Our"
LAYOUT = list(dict.fromkeys([*L.rolled_columns(CENTER), *L.filled_columns(CENTER)]))


def places(kind, folder):
    return kind(**{n: (f"{folder}/{n}",) if n.endswith("_csv") else f"{folder}/{n}" for n in kind.__dataclass_fields__})


def write(spark, path, columns, *data):
    table = spark.createDataFrame([tuple(d.get(c) for c in columns) for d in data], ", ".join(f"`{c}` string" for c in columns))
    write_tab(table.coalesce(1), path)


def participants(spark, folder):
    at = places(sheets.ParticipantSheets, folder)
    job = "Work Experience/Designation"
    write(spark, at.export, LAYOUT,
          {"SP ID": "11", "Gender": "F", job: "cook", "Education/Qualifications": "BSc", "Education/Specialization": "soup", "Languages": "en"},
          {job: "clerk", "Languages": "ta"}, {"SP ID": "12", "Gender": "M", job: "guard", L.GRADUATION: "2024"},
          {"SP ID": "12", "Skills": "calm"})
    write(spark, at.mapping, ["SP ID", "Person Id", "Name"], {"SP ID": "11", "Person Id": "p11", "Name": "Ann"})
    request = ["Request Name", "Job Title", "Job Description", "Department", "Skills/Keywords", "Skills", "Languages"]
    write(spark, at.requests, request,
          dict(zip(request, ["R1", "Cook", "cook soup", "Kitchen", "knives", "soup", "en"])),
          dict(zip(request, ["R2", "Guard", "guard, gate", "Gate", "calm", "watch", "ta"])))
    write(spark, at.generic, ["Job Title", L.GENERIC_DESCRIPTION], {"Job Title": "Helper", L.GENERIC_DESCRIPTION: "helps"})
    return at


def test_participants_job_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    at, manifest = participants(spark, str(tmp_path / "sheets")), str(tmp_path / "manifest")

    def start(run="r1"):
        return sheets.participants_job(spark, at, manifest, run, CENTER, k=2, width=32)

    # Stopped in a stage; then after a stage's rows were appended, before its marker.
    with monkeypatch.context() as patch:
        patch.setattr(sheets, "publish_allocation", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            start()
    assert stamped(spark, at.final, "v-") and not stamped(spark, at.allocation, "v-")
    with monkeypatch.context() as patch:
        appended = sheets.append_participants
        patch.setattr(sheets, "append_participants", lambda *a: (appended(*a), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            start()
    assert read_appended(spark, at.backend_participants).count() == 2
    done = start()
    assert done.made == ["sync-participants", "sync-predictions", "formatted"] and start().made == []
    assert len(stamped(spark, at.rolled, "v-")) == 1  # the roll-up was made once
    assert read_appended(spark, at.backend_participants).count() == 2
    report = done.do("sync-participants", dict)
    assert report["rows_before"] == "0" and report["rows_added"] == "2" and report["rows_after"] == "2"
    assert rows(read_tab(spark, at.final_csv[0], order=None), "SP ID", "Name", "Gender") == [("11", "Ann", "F"), ("12", None, "M")]
    # Two designations without a separator known to the list roll-up are one text.
    ranked = [tuple(r) for r in read_tab(spark, at.formatted, order=None).orderBy("SP ID", "Rank").collect()]
    assert [(r[0], r[1], r[4]) for r in ranked if r[4] == "1"] == [("11", "Cook", "1"), ("12", "Guard", "1")]
    assert {r[3] for r in ranked} <= {"Kitchen", "Gate", None}
    predictions = read_tab(spark, at.predictions, order=None)
    assert predictions.columns[:3] == ["SP ID", "Pred Job Title: 1", "Pred Job Title: 2"]
    # Another run adds nothing to the growing tables, and replaces the tabs.
    assert len(start("r2").made) == 8
    assert [read_appended(spark, p).count() for p in (at.backend_filled, at.backend_participants, at.backend_predictions)] == [
        read_tab(spark, at.filled, order=None).count(), 2, 2]
    assert len(stamped(spark, at.rolled, "v-")) == 2


def test_requests_job_replaces_main_and_appends_once(spark, tmp_path):
    at = places(sheets.RequestSheets, str(tmp_path))
    columns = ["Request Name", "Job Title", "Job Description", "Department", "Skills/Keywords", "Educational Qualification"]
    write(spark, at.requests, columns, dict(zip(columns, ["R1", "Cook", "boil", "Kitchen", "a", "q"])),
          {"Skills/Keywords": "b"}, dict(zip(columns, ["R2", "Clerk", "files", "Office", None, None])))
    write(spark, at.old, columns, dict(zip(columns, ["R0", "Old", "was", "Attic", "x", None])),
          dict(zip(columns, ["R1", "Older cook", "was", "Kitchen", "x", None])))
    write(spark, at.main, ["Request Name", "Job Title", "Note"], {"Request Name": " R1 ", "Job Title": "stale", "Note": "n"},
          {"Request Name": "R9", "Job Title": "Left", "Note": "kept"})
    write(spark, at.generic, ["Job Title", L.GENERIC_DESCRIPTION], {"Job Title": "Helper", L.GENERIC_DESCRIPTION: "helps"})
    for run in ("a", "a", "b"):
        sheets.requests_job(spark, at, str(tmp_path / "manifest"), run)
    assert rows(read_tab(spark, at.clean_csv[0], order=None), "Request Name", "Skills/Keywords") == [("R1", "a,b"), ("R2", None)]
    new = AppendLog(spark, at.new)
    assert [e.batch for e in new.entries()] == ["a-new", "b-new"] and new.read().count() == 2
    want = [("R0", "Old", "Old VRF ID", None), ("R1", "Cook", "New VRF ID", None), ("R2", "Clerk", "New VRF ID", None),
            ("R9", "Left", None, "kept")]
    assert rows(read_tab(spark, at.main, order=None), *cols(["Request Name", "Job Title", L.STATUS, "Note"])) == want
    nodes = spark.read.parquet(f"{at.vectors}/{max(stamped(spark, at.vectors, 'v-').values())}")
    assert {r["Job Title"] for r in nodes.collect()} == {"Cook", "Clerk", "Old", "Helper"}


def test_export_is_sorted_before_its_rows_are_wide(spark, tmp_path):
    events = [(i, i % 3, "view" if i % 2 else "click", float(i), "p") for i in (7, 1, 5, 0, 3, 6, 2, 4)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double, props string").repartition(
        3).write.parquet(str(tmp_path / "events.parquet"))
    made = jobs.export(spark, str(tmp_path), in_order=True)
    assert [r[ORDER] for r in made.collect()] == list(range(8))
    assert rows(made) == rows(jobs.export(spark, str(tmp_path)))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("Sort") and "view" not in plan[plan.index("Sort"):]
    write_tab(made.drop(ORDER), str(tmp_path / "tab"))
    wide = jobs.export(spark, str(tmp_path))
    write_tab(wide, str(tmp_path / "sorted"), order=ORDER)
    assert rows(read_tab(spark, str(tmp_path / "tab"))) == rows(read_tab(spark, str(tmp_path / "sorted")))


def test_wide_rows_are_written_by_methods_that_are_compiled(spark, table, tmp_path, monkeypatch):
    key, limits = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key)
    writer = type(table([], "a string").write)
    monkeypatch.setattr(writer, "csv", lambda self, path, f=writer.csv: (limits.append(spark.conf.get(key)), f(self, path))[1])
    monkeypatch.setattr(writer, "parquet", lambda self, path, f=writer.parquet: (limits.append(spark.conf.get(key)), f(self, path))[1])
    write_tab(table([("a",)], "v string"), str(tmp_path / "tab"))
    at = participants(spark, str(tmp_path / "sheets"))
    roll_up_participants(read_tab(spark, at.export), CENTER)
    assert limits[0] == "8000" and limits[-1] == "8000" and spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError):
        with short_methods(spark):
            1 / 0
    assert spark.conf.get(key) == before


def test_a_stage_is_done_once_per_run(spark, tmp_path):
    calls = []
    for run in ("a", "a", "b"):
        made = Stages(spark, str(tmp_path), run).do("x", lambda: calls.append(1) or {"n": str(len(calls))})
    assert len(calls) == 2 and made == {"n": "2"}
