import datetime

from helpers import rows
from pyspark.sql import functions as F

from rollmatch.functions import dates, jsontext, text
from rollmatch.operators import reshape
from rollmatch.operators.rules import adjust_titles


def test_parse_day(table):
    df = table([("2020-1-5",), ("2020-02-30",), ("NA",), ("20-1-5",), ("2020-01-05 ",), (None,)], "s string")
    got = [r[0] for r in df.select(dates.parse_day(F.col("s"))).collect()]
    assert got == [datetime.date(2020, 1, 5), None, None, None, None, None]


def test_date_lists(table):
    df = table([
        (1, ["2020-1-5", "2021-01-01"], ["2021-01-04", "bad"]), (2, ["2020-1-5"], ["2021-01-04", "2022-01-01"]),
        (3, ["NA"], ["2020-01-01"]), (4, [], [])], "id int, s array<string>, e array<string>")
    starts, ends = dates.repair_date_lists(F.col("s"), F.col("e"))
    got = df.select("id", dates.years_between_lists(F.col("s"), F.col("e")), starts, ends).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [
        ([1.0, None], ["2020-1-5", "2021-01-01"], ["2021-01-04", "bad"]),
        (None, ["NA"], ["NA"]), (None, ["NA"], ["NA"]), (None, [], [])]


def test_list_repr_prints_like_a_list(table):
    values = ["a", "it's", 'say "it\'s"', "back\\slash", "line\nbreak", "tab\t"]
    shown = table([(values,)], "v array<string>").select(text.list_repr(F.col("v"))).first()[0]
    assert shown == str(values)


def test_retrieval_text(table):
    df = table([(7, ["cook", "clerk"], ["BSc", "x"], ["maths"])], "id int, d array<string>, q array<string>, s array<string>")
    both, once = df.select(*[
        text.retrieval_text(F.col("id"), F.col("d"), F.col("q"), F.col("s"), legacy) for legacy in (True, False)]).first()
    head = " Participant 7 worked with designations: cook, clerk, "
    tail = head[:-2] + ". " + " The participant has a BSc education specialized in maths. "
    assert both == head + tail and once == tail


def test_experience_sentences_stop_at_the_shortest_list(table):
    df = table([(["a", "b"], ["t1", "t2", "t3"], ["2020-01-31", "x"], ["2021-03-01", "2021-01-01"])],
               "i array<string>, t array<string>, s array<string>, e array<string>")
    got = df.select(text.experience_sentences(F.col("i"), F.col("t"), F.col("s"), F.col("e"))).first()[0]
    assert got == ["A a in the industry doing t1 tasks for 14 months.", "A b in the industry doing t2 tasks."]


def test_department_label(table):
    df = table([("A: B: C",), ("plain",), (" : ",), ("",), (None,), ("NaN",)], "d string")
    assert [r[0] for r in df.select(text.department_label(F.col("d"))).collect()] == ["B", "plain", "", "NA", "NA", "NA"]


def test_newlines(table):
    df = table([("\n",), ("a\nb",)], "v string")
    assert [tuple(r) for r in df.select(text.newline_cells(F.col("v")), text.newlines_to_spaces(F.col("v"))).collect()] == [
        (" ", " "), ("a\nb", "a b")]


def test_json_object(table):
    replies = ['text {"a": 1, "b": {"c": [1]}} end', "no braces", '{"a": 1} or {"b": 2}', '{"a": 1}, {"b": 2}', "{broken",
               '{"a": null}', '{"a": "x\ny"}', "{}", None]
    df = table([(i, r) for i, r in enumerate(replies)], "i int, r string")
    got = {r["i"]: r["m"] for r in df.select("i", jsontext.json_object(F.col("r")).alias("m")).collect()}
    assert got[0] == {"a": "1", "b": '{"c":[1]}'}
    assert got[5] == {"a": None}
    assert all(got[i] == {} for i in (1, 2, 3, 4, 7, 8))
    tags = df.withColumn("m", jsontext.json_object(F.col("r")))
    a = {r["i"]: r["a"] for r in tags.select("i", jsontext.tag_value(F.col("m"), "a", F.col("r")).alias("a")).collect()}
    assert a[0] == "1" and a[1] == "No info found" and a[5] == "" and a[8] == "Processing failed"


def test_title_rules(table):
    na, some = "['NA']", "['x']"
    df = table([
        (1, "Researcher", na, na, na, "2024"), (2, "Researcher", na, some, na, "2024"), (3, "Researcher", na, some, na, "2020"),
        (4, "Researcher", some, na, na, "2024"), (5, "Cook", na, na, na, "2024"), (6, None, na, na, na, "2024"),
        (7, "Researcher", " ['NA'] ", None, na, "2025.0"), (8, "Researcher", na, some, some, "soon")],
        "id int, t string, w string, q string, s string, y string")
    got = rows(adjust_titles(df, "t", "w", "q", "s", "y"), "id", "t")
    assert [t for _, t in got] == ["Ashram Support", "Fresher", "Ashram Support", "Researcher", "Cook", None, "Fresher",
                                   "Ashram Support"]


def test_explode_paired_rejects_unequal_lists(table):
    df = table([(1, ["a", "b"], ["c", "d"]), (2, None, []), ], "k int, x array<string>, y array<string>")
    assert rows(reshape.explode_paired(df, ["x", "y"])) == [(1, "a", "c"), (1, "b", "d"), (2, None, None)]
    bad = table([(1, ["a"], ["c", "d"])], "k int, x array<string>, y array<string>")
    try:
        reshape.explode_paired(bad, ["x", "y"]).collect()
    except Exception as e:  # noqa: BLE001
        assert "differ in length" in str(e)
    else:
        raise AssertionError("unequal lists passed")


def test_pivot_and_unpivot_are_inverse_on_full_rows(table):
    long = table([("p", 1, "cook", "r1"), ("p", 2, "clerk", "r2"), ("q", 1, "cook", None)],
                 "id string, rank int, title string, request string")
    wide = reshape.ranked_to_wide(long, "id", "rank", {"title": "T", "request": "R"}, 2, {"title": "NA", "request": "NA"})
    assert rows(wide) == [("p", "cook", "clerk", "r1", "r2"), ("q", "cook", "NA", None, "NA")]
    back = reshape.wide_to_ranked(wide, "id", [("T: 1", "R: 1", "D 1"), ("T: 2", "R: 2", "D 2"), ("T: 3", "R: 3", "D 3")],
                                  names=("title", "request", "dept", "rank"))
    assert rows(back, "id", "rank", "title", "request") == [
        ("p", 1, "cook", "r1"), ("p", 2, "clerk", "r2"), ("q", 1, "cook", "NA")]


def test_department_column_without_values_gives_way_to_the_id(table):
    df = table([("p", "cook", "lab: x", None), ("q", "clerk", "plain", "")], "id string, t string, r string, d string")
    got = reshape.wide_to_ranked(df, "id", [("t", "r", "d")])
    assert rows(got, "id", "Department") == [("p", "x"), ("q", "plain")]
    mixed = table([("p", "cook", "lab: x", None), ("q", "clerk", "plain", "D: y")], "id string, t string, r string, d string")
    assert rows(reshape.wide_to_ranked(mixed, "id", [("t", "r", "d")]), "id", "Department") == [("p", "NA"), ("q", "y")]
