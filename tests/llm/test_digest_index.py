import hashlib
import re
from collections import defaultdict

from edge_cases import edge_rows
from pyspark.sql import functions as F

from rollmatch.llm.digest_index import DigestIndex, digests, keep_one, membership


def digest(text):
    return hashlib.sha256(re.sub(r"[ \t-\r]", "", text or "").encode()).hexdigest()


def brute(rows):
    """(doc_id, keep_id, group_size, sha) per row, and how many rows of each group stay."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[digest(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    best = {k: min(v, key=lambda x: x[:3])[3] for k, v in groups.items()}
    return [(r[0], best[d], len(groups[d]), d) for r in rows for d in [digest(r[1])]], len(groups)


def check(df, index, rows, loads):
    found = digests(df)
    for k in range(loads):
        index.add(found.where(F.col("best.row") % loads == k))
    got = membership(found, index).collect()
    want, groups = brute(rows)
    assert sorted(map(str, (tuple(r)[:3] + (r.text_sha256,) for r in got))) == sorted(map(str, want))
    assert sum(r.kept for r in got) == groups == len({r.text_sha256 for r in got if r.kept})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    return found


def test_edge_cases_in_one_and_several_loads(edge, empty, spark, tmp_path):
    for loads in (1, 3):
        index = DigestIndex(spark, str(tmp_path / f"loads{loads}"), buckets=4)
        found = check(edge, index, edge_rows(), loads)
        assert index.add(found).count() == 0  # the same load again
    assert membership(digests(empty), DigestIndex(spark, str(tmp_path / "none"), 4)).count() == 0


def test_equal_ids_texts_and_a_hot_group(spark, tmp_path):
    rows = [(7, "a b")] * 300 + [(5, "ab"), (9, "a  b"), (3, " a b"), (None, "a b   "), (1, None), (2, ""), (1, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(df, DigestIndex(spark, str(tmp_path / "hot"), 4), rows, 2)


def test_better_rows_of_later_loads_stand(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "i"), buckets=4)
    first = spark.createDataFrame([(5, "x y"), (6, "z")], "doc_id long, text string")
    later = spark.createDataFrame([(9, "x  y"), (4, "z"), (8, "new")], "doc_id long, text string")
    assert sorted(r[0] for r in keep_one(first, index).collect()) == [5, 6]
    assert sorted(r[0] for r in keep_one(later, index).collect()) == [4, 8, 9]
    assert keep_one(first, index).count() == 0
    again = DigestIndex(spark, str(tmp_path / "i"), buckets=999)  # the folder knows its buckets
    assert again.buckets == 4 and again.entries().count() == 5 and again.standing().count() == 3


def test_the_index_is_never_shuffled(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "i"), buckets=4)
    rows = digests(spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string"))
    index.add(rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = index.fresh(rows)._jdf.queryExecution().executedPlan().toString()
        standing = index.standing()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Python" not in plan
    held = plan[plan.index("LeftAnti"):].split("\n")
    scan = next(i for i, line in enumerate(held) if index.table in line)
    assert "Bucketed: true" in held[scan]
    side = next(i for i in range(scan, 0, -1) if held[i].lstrip(" :").startswith("+- "))
    assert not any("Exchange" in line for line in held[side:scan])
    assert "Exchange" not in standing
