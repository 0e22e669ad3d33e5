import random
from collections import Counter

import pytest
from edge_cases import edge_rows
from pyspark.sql import functions as F

from rollmatch.llm import line_dedup as L


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_within_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(("", "a", "b", "c"))
        b = "".join(b)
        for edits in (1, 2, 3):
            assert L.within(a, b, edits) == (distance(a, b) <= edits)


def brute(rows):
    """Texts left, from every pair of distinct lines."""
    first = {}
    for d, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0])):
        for i, line in enumerate(text.split("\n")):
            if len(line) >= L.MIN_CHARS:
                first.setdefault(line, (d, i))
    lines = list(first)
    near = {x for k, x in enumerate(lines) if any(
        abs(len(x) - len(y)) < 2 and Counter(x) - Counter(y) <= Counter(x) and sum((Counter(x) - Counter(y)).values()) < 2
        and distance(x, y) <= 1 for y in lines[:k])}
    return Counter((d, None if t is None else "\n".join(
        x for i, x in enumerate(t.split("\n")) if len(x) < L.MIN_CHARS or (x not in near and first[x] == (d, i))))
        for d, t in rows)


def variants(n):
    rng = random.Random(n)
    line = "".join(rng.choice("abcde ") for _ in range(40))
    rows = []
    for d in range(n):
        made = []
        for _ in range(4):
            x = list(line)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                at = rng.randrange(len(x))
                x[at:at + rng.randint(0, 1)] = rng.choice(("", "x", "é", "y"))
            made.append("".join(x))
        rows.append((d, "\n".join(made + ["short", ""])))
    return rows


@pytest.mark.parametrize("group", [256, 3])
def test_lines_match_brute_force(table, monkeypatch, group):
    monkeypatch.setattr(L, "GROUP", group)
    rows = variants(25) + [(90, None), (91, ""), (92, "a line that stands twice here\na line that stands twice here")]
    got = L.dedup_lines(table(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == brute(rows)
    for r in got:
        before = dict(rows)[r.doc_id]
        assert r.n_lines == (0 if before is None else before.count("\n") + 1)
        assert r.n_dropped == r.n_lines - (0 if r.text is None else r.text.count("\n") + 1 if r.text or r.n_dropped == 0
                                           else r.n_lines - r.n_dropped)


def test_edge_cases(edge, empty):
    out = L.dedup_lines(edge)
    assert out.columns == [c for c in edge.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    got = out.collect()
    assert len(got) == len(edge_rows())
    texts = {r.doc_id: r.text for r in got}
    assert texts[2] is None and texts[3] == "" and texts[12] == "\n" * 3000 and texts[9] != ""
    assert len({r.text for r in got if r.doc_id == 8}) == 1
    assert texts[7].count("\n") + 1 >= 1 and len(texts[13]) < 2000
    assert L.dedup_lines(empty).count() == 0
