import numpy as np
import pytest

from rollmatch.operators import vectors


def brute(queries, items, k, metric):
    out = []
    for q, qv in queries:
        qv = np.array(qv)
        scored = []
        for i, iv in items:
            iv = np.array(iv)
            s = (qv @ iv / (np.linalg.norm(qv) * np.linalg.norm(iv))) if metric == "cosine" else -np.linalg.norm(qv - iv)
            scored.append((-round(s, 9), i, s))
        out += [(q, r + 1, i, round(s, 8) + 0.0) for r, (_, i, s) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    items = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    # A third of the items are copies of one vector, so ties cross the k-th place.
    items = [(i, items[0][1] if i < 40 else v) for i, v in items]
    queries = [(q, rng.normal(size=6).tolist()) for q in range(30)] + [(30, items[0][1])]
    frame = lambda rows: spark.createDataFrame(rows, "id bigint, v array<double>")
    return queries, items, frame(queries), frame(items)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("options", [{}, {"bound": 0, "block_bytes": 48 * 13}, {"bound": 0, "block_bytes": 48 * 50}])
def test_nearest_equals_brute_force(data, metric, options, monkeypatch):
    monkeypatch.setattr(vectors, "SLICE", 500)
    queries, items, q, i = data
    got = vectors.nearest(q, i, 3, "id", "v", "id", "v", metric, **options).collect()
    assert sorted((r[0], r[1], r[2], round(r[3], 8) + 0.0) for r in got) == brute(queries, items, 3, metric)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_cells_with_zero_vectors_copies_and_few_items(spark, metric, monkeypatch):
    monkeypatch.setattr(vectors, "VISITS", 7)
    rng = np.random.default_rng(8)
    items = [(i, rng.normal(size=4).round(1).tolist()) for i in range(60)] + [(60 + i, [0.0] * 4) for i in range(30)]
    queries = [(q, rng.normal(size=4).round(1).tolist()) for q in range(25)] + [(25, [0.0] * 4), (26, items[3][1])]
    q, i = (spark.createDataFrame(r, "id bigint, v array<double>") for r in (queries, items))
    for k in (1, 5, 200):
        got = vectors.nearest(q, i, k, "id", "v", "id", "v", metric, bound=0, block_bytes=32 * 4).collect()
        scored = sorted((r[0], r[1], r[2]) for r in got)
        if metric == "l2":
            assert scored == [r[:3] for r in brute(queries, items, k, "l2")]
        else:  # a vector of length zero scores 0 with every other one
            unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
            want = []
            for a, av in queries:
                ranked = sorted((-round(float(unit(av) @ unit(bv)), 9) + 0.0, b) for b, bv in items)[:k]
                want += [(a, r + 1, b) for r, (_, b) in enumerate(ranked)]
            assert scored == sorted(want)


def test_a_query_visits_few_cells_and_an_item_moves_once(spark, monkeypatch):
    """Twenty clusters: no more than four visits a query on average, of twenty cells; no item is copied."""
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(20, 16)) * 20
    item = [(i, (middle[i % 20] + rng.normal(size=16)).tolist()) for i in range(1000)]
    query = [(q, (middle[q % 20] + rng.normal(size=16)).tolist()) for q in range(200)]
    q, i = (spark.createDataFrame(r, "id bigint, v array<double>") for r in (query, item))
    seen = []
    meet = vectors._meet

    def watched(visits, items, parts, k, *rest):
        seen.append((visits.count(), sum(parts), items.count()))
        return meet(visits, items, parts, k, *rest)

    monkeypatch.setattr(vectors, "_meet", watched)
    got = vectors.nearest(q, i, 3, "id", "v", "id", "v", "l2", bound=0, block_bytes=8 * 16 * 50)
    assert sorted((r[0], r[1], r[2]) for r in got.collect()) == [r[:3] for r in brute(query, item, 3, "l2")]
    assert len(seen) == 2 and sum(s[0] for s in seen) <= 4 * 200 and all(s[2] == 1000 for s in seen)


def test_fewer_items_than_k_and_missing_vectors(spark, data):
    _, _, q, i = data
    few = i.where("id >= 118")
    got = vectors.nearest(q.where("id = 1"), few, 5, "id", "v", "id", "v")
    assert got.count() == 2
    assert vectors.nearest(q, i.where("id < 0"), 3, "id", "v", "id", "v").count() == 0


def test_default_rows(spark, data):
    _, _, q, i = data
    nodes = i.selectExpr("id", "v", "concat('t', id) AS title")
    got = vectors.retrieve_jobs(q, nodes, 2, "id", "v", "id", {"title": "title"}, searchable=q["id"] > 28,
                                default={"title": "none"}).collect()
    assert len(got) == 31 * 2
    assert {r["title"] for r in got if r["id"] <= 28} == {"none"}
    assert all(r["title"].startswith("t") for r in got if r["id"] > 28)


def test_term_weights_and_dense_vectors(spark):
    docs = spark.createDataFrame([(1, "A b a"), (2, " b "), (3, "")], "id int, t string")
    got = {(r["id"], r["term"]): round(r["weight"], 6) for r in vectors.term_weights(docs, "id", "t").collect()}
    assert got == {(1, "a"): round(2 * np.log(4 / 2), 6), (1, "b"): round(np.log(4 / 3), 6), (2, "b"): round(np.log(4 / 3), 6)}
    dense = {r["id"]: r["embedding"] for r in vectors.embed_text(docs, "id", "t", 8).collect()}
    assert set(dense) == {1, 2} and all(len(v) == 8 for v in dense.values())


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_a_query_is_sent_once_per_group_of_cells_and_few_pairs_are_scored_exactly(spark, metric, monkeypatch):
    """Vectors without clusters: every query is compared with every one of some thirty cells."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, "id bigint, v array<double>")
    seen, meet = [], vectors._meet

    def watched(visits, *rest):
        seen.append(visits.count())
        return meet(visits, *rest)

    monkeypatch.setattr(vectors, "_meet", watched)
    got = vectors.nearest(table, table, 3, "id", "v", "id", "v", metric, bound=0, block_bytes=8 * 32 * 20)
    assert sorted((r[0], r[1], r[2], round(r[3], 8) + 0.0) for r in got.collect()) == brute(rows, rows, 3, metric)
    assert sum(seen) <= 2 * 600

    pairs, exact = [], vectors._exact

    def counted(queries, items, q, i, metric):
        pairs.append(len(q))
        return exact(queries, items, q, i, metric)

    monkeypatch.setattr(vectors, "_exact", counted)
    matrix = vectors._matrix([r[1] for r in rows], metric == "cosine")
    best = vectors._Best(matrix, 3, metric)
    best.add(matrix, vectors._single(matrix, metric, True))
    q, i, _, rank = best.rows()
    assert sorted(zip(q.tolist(), rank.tolist(), i.tolist())) == [r[:3] for r in brute(rows, rows, 3, metric)]
    assert sum(pairs) <= 4 * 600


def test_a_term_meets_its_count_as_one_row_per_part(spark):
    """No exchange is of one row per text and term: texts move once, then lists of the texts that hold a term."""
    docs = spark.createDataFrame([(i, f"the word w{i} the") for i in range(50)] + [(3, "word again"), (None, "the lone"), (None, "lone")],
                                 "id bigint, text string")
    made = vectors.term_weights(docs, "id", "text")
    plan = made._jdf.queryExecution().sparkPlan().toString() + made._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and not any("id#" in line.split("hashpartitioning")[1].split(")")[0] for line in moved if "hashpartitioning" in line)
    got = {(r["id"], r["term"]): round(r["weight"], 9) for r in made.collect()}
    assert got[0, "the"] == round(2 * np.log(54 / 52), 9) and got[3, "word"] == round(2 * np.log(54 / 51), 9)
    assert got[3, "again"] == round(np.log(54 / 2), 9) and got[None, "lone"] == round(2 * np.log(54 / 2), 9) and len(got) == 153
