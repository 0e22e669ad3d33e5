import pytest
from helpers import rows

from rollmatch.operators import lookup, merge, schema
from rollmatch.operators.rollup import count_report


def test_merge_keeps_a_null_id_and_drops_blank_ones(table):
    old = table([(1, "a", "old"), (2, None, "n1"), (3, " ", "blank"), (4, "b", "old")], "_ord int, id string, v string")
    new = table([(1, "a", "new"), (2, None, "n2")], "_ord int, id string, v string")
    got = merge.merge_old_new(old, new, "status", "Old", "New")
    assert rows(got, "id", "v", "status") == [("a", "new", "New"), ("b", "old", "Old"), (None, "n2", "New")]


def test_upsert_keeps_orphans_and_trims(table):
    merged = table([("a ", 1)], "id string, v int")
    main = table([(" a", "gone"), ("z ", "kept")], "id string, old string")
    assert rows(merge.upsert_with_orphans(merged, main, "id")) == [("a", 1, None), ("z", None, "kept")]
    assert rows(merge.upsert_with_orphans(merged, main.select("old"), "id"), "id", "old") == [
        ("", "gone"), ("", "kept"), ("a", None)]


def test_combine_skips_empty_inputs_and_falls_back_to_present_keys(table):
    one = table([(1, "r", "t1"), (2, "r", "t2")], "_ord int, request string, title string")
    with pytest.raises(ValueError):
        merge.drop_empty([one.where("false"), one.where("_ord > 9")])
    assert len(merge.drop_empty([one, one.where("false")])) == 1
    got = merge.combine_keep_last([one.drop("title"), one.drop("title")], ["request", "title"])
    assert rows(got) == [(2, "r")]


def test_sync_is_idempotent_and_adds_up(table):
    source = table([(" 1", "a"), ("2", "b"), ("2", "c"), (None, "n")], "id string, v string")
    target = table([("1 ", "x")], "id string, w string")
    added = merge.new_key_rows(source, target, "id")
    assert rows(added) == [("2", "b"), ("2", "c"), (None, "n")]
    after = target.select("id").unionByName(added.select("id"))
    assert merge.new_key_rows(source, after, "id").count() == 0
    report = count_report(target, added, source, "id").first()
    assert report["rows_after"] == after.count() == report["rows_before"] + report["rows_added"]


def test_full_row_sync_treats_null_as_equal_and_survives_duplicate_targets(table):
    source = table([(1, None), (2, "x"), (3, "y")], "a int, b string")
    target = table([(None, "1", "t"), (None, "1", "u"), ("x", "9", "t")], "b string, a string, c string")
    assert rows(merge.new_rows(source, target)) == [(2, "x"), (3, "y")]


def test_alignment_only_with_a_filled_target(table):
    source = table([("1", "a", "extra")], "id string, v string, more string")
    target = table([("9", "s", "b")], "v string, status string, id string")
    assert merge.sync_aligned(source, target, "id").columns == ["v", "status", "id"]
    assert rows(merge.sync_aligned(source, target, "id")) == [("a", "", "1")]
    assert merge.sync_aligned(source, target.where("false"), "id").columns == source.columns


def test_guards(table):
    df = table([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        schema.require(df, ["a", "c"])
    with pytest.raises(ValueError):
        schema.select_exact(df, ["c"])
    assert schema.move_column(df, "a", after="b").columns == ["b", "a"]


def test_enrich_doubles_rows_and_matches_null_keys(table):
    left = table([(1, "x"), (2, "y"), (None, "z")], "id int, v string")
    right = table([("1", "a"), ("1", "b"), (None, "n")], "id string, name string")
    assert rows(lookup.enrich(left, right, "id", ["name"], fill="")) == [
        ("1", "x", "a"), ("1", "x", "b"), ("2", "y", ""), (None, "z", "n")]


def test_labels_in_first_seen_order_without_nulls(table):
    jobs = table([(1, "cook", "kitchen"), (2, "cook", None), (3, "cook", "garden"), (4, "cook", "kitchen"), (5, "idle", None)],
                 "_ord int, title string, dept string")
    results = table([("cook", "none"), (None, "idle")], "t1 string, t2 string")
    got = lookup.attach_labels(results, jobs, "title", "dept", ["t1", "t2"], ["d1", "d2"])
    assert rows(got, "d1", "d2") == [("NA", "idle:  "), ("cook: kitchen, garden ", "none:  ")]
