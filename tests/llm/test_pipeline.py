import importlib
import random
import sys

import pytest
from edge_cases import SCHEMA, edge_rows, prose, row

import corpus_pipeline
from rollmatch.llm.queries import ORACLES, QUERIES


def test_registered_queries():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(ORACLES) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows):
        path = str(tmp_path / "in")
        columns = corpus_pipeline.COLUMNS
        spark.createDataFrame(rows, SCHEMA).select(*columns).write.parquet(f"{path}/documents.parquet")
        return path
    return write


def test_stages_return_documents_and_take_effect(spark, folder):
    rng = random.Random(3)
    copy = prose(rng, 200)
    rows = edge_rows() + [row(300, "short one"), row(301, copy), row(302, copy.replace("the", "THE", 1), source="c"),
                          row(303, "a line of its own, long enough\nanother one that stands in two documents\n" + prose(rng, 60)),
                          row(304, "a line of its own, long enough\n" + prose(rng, 60)),
                          row(305, "a line of its own, long enough\nanother one that stands in two documents\n \n")]
    path = folder(rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.cut(stage(spark, docs, path))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS and docs.count() <= (3 if name == "mixing" else 1) * before.count()
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in seen.items()}
    assert 300 not in ids["quality_rules"] and {301, 302, 303, 304} <= set(ids["quality_rules"])
    # Only documents that lost every word with their lines go.
    gone = set(ids["quality_rules"]) - set(ids["line_dedup"])
    assert 305 in gone and 304 not in gone and all((r.text or "").split() for r in seen["line_dedup"].collect())
    lines = {r.doc_id: r.text for r in seen["line_dedup"].collect()}
    assert lines[303].startswith("a line of its own") and not lines[304].startswith("a line of its own")
    assert set(ids["near_dedup"]) <= set(ids["line_dedup"]) and set(ids["mixing"]) <= set(ids["near_dedup"])
    whole = seen["packing"].filter("piece = 0").count()
    assert whole == len(ids["mixing"]) == corpus_pipeline.run(spark, path).filter("piece = 0").count()


def test_nothing_in_nothing_out(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0


def test_entry_module_works_without_these_operators(monkeypatch):
    import __spark_entry__

    for name in [m for m in sys.modules if m.startswith(("rollmatch.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "rollmatch.llm", None)
    try:
        with pytest.raises(ModuleNotFoundError):
            importlib.import_module("rollmatch.llm.queries")
        entry = importlib.reload(__spark_entry__)
        assert not any(k.startswith("op") and k[2].isdigit() for k in entry.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
