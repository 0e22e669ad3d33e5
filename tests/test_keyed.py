import re

import pytest
from helpers import rows

from rollmatch.operators import merge
from rollmatch.sources.keyed import KeyedTable
from rollmatch.sources.versions import current_path


def keys(table, data):
    return table(data, "k string, v string")


def test_unseen_append_and_upsert_equal_the_plain_operators(spark, table, tmp_path):
    target = keys(table, [(" a ", "1"), ("b", None), (None, "n"), ("", "blank"), ("1:b", "x")])
    batch = keys(table, [("a", "9"), ("c", "9"), ("c", "8"), (None, "9"), (" ", "9"), ("b ", "9"), ("-", "9")])
    kept = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    assert not kept.exists()
    kept.replace(target)
    assert rows(kept.unseen(batch)) == rows(merge.new_key_rows(batch, target, "k")) == [("-", "9"), ("c", "8"), ("c", "9")]
    merged = keys(table, [("a", "new"), (None, "new"), ("d", "new")])
    want = rows(merge.upsert_with_orphans(merged, target, "k"))
    assert rows(kept.append(batch)) == [("-", "9"), ("c", "8"), ("c", "9")]
    assert kept.append(batch).count() == 0 and kept.rows().count() == 8  # sent again
    # Another session finds table and buckets in the folder; the upsert reads the version it replaces.
    spark.sql(f"DROP TABLE {kept._name(current_path(spark, kept.base))}")
    again = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=999)
    assert again.buckets == 4 and again.rows().count() == 8
    again.upsert(merged)
    assert rows(again.rows()) == sorted([*want, ("-", "9"), ("c", "8"), ("c", "9")], key=str)


def test_whole_rows_null_equal_to_null(spark, table, tmp_path):
    data = [("a", None), (None, None), ("x", "y"), ("1", "2:3"), ("", None)]
    kept = KeyedTable(spark, str(tmp_path / "t"), ["k", "v"], buckets=3)
    kept.replace(keys(table, data[:3]))
    batch = keys(table, data + [("x", "y"), ("-", ""), ("12", ":3")])
    assert rows(kept.unseen(batch)) == rows(merge.new_rows(batch, keys(table, data[:3]))) == sorted(
        [("1", "2:3"), ("", None), ("-", ""), ("12", ":3")], key=str)


@pytest.mark.parametrize("what", ["unseen", "orphans"])
def test_the_table_is_not_shuffled(spark, table, tmp_path, what):
    kept = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    kept.replace(keys(table, [(str(i), "v") for i in range(300)]))
    batch = keys(table, [(str(i), "w") for i in range(250, 350)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = getattr(kept, what)(batch)
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        assert found.count() == {"unseen": 50, "orphans": 250}[what]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = [line for line in plan if re.match(r"[ :]*([+:]- |\*\()", line)]  # the blanks that are trimmed break lines
    scan = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-"))
    above, least = [], depth  # the nodes between the scan and the join
    for line in reversed(plan[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < least:
            least = at
            above.append(line)
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    assert sum("Exchange" in line for line in plan) == 1  # the batch
