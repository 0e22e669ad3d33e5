import hashlib
import random

import pytest
from edge_cases import edge_rows, prose

from rollmatch.llm.fingerprints import Fingerprint, edited, fingerprints, pieces


def test_sums_do_not_depend_on_order_and_can_be_undone():
    rng = random.Random(1)
    parts = [prose(rng, 12).replace("\n", " ") for _ in range(30)]
    whole = Fingerprint.of("\n".join(parts))
    rng.shuffle(parts)
    assert str(Fingerprint.of("\n\n".join(parts))) == str(whole)
    one, rest = Fingerprint.of(parts[0]), Fingerprint.of("\n".join(parts[1:]))
    assert str(one + rest) == str(whole) and str(whole - one) == str(rest)
    assert str(whole + one) != str(whole) and str(Fingerprint.read(str(whole))) == str(whole)
    assert set(str(Fingerprint.of(None))) == {"0"}


def test_likeness_follows_the_share_of_common_paragraphs():
    rng = random.Random(2)
    parts = [prose(rng, 12).replace("\n", " ") for _ in range(40)]
    whole = Fingerprint.of("\n".join(parts))
    for kept in (39, 30, 20, 5):
        other = Fingerprint.of("\n".join(parts[:kept] + [f"new {i}" for i in range(40 - kept)]))
        assert abs(whole.likeness(other) - kept / (80 - kept)) < 0.2
    assert whole.likeness(whole) == 1.0 == Fingerprint.of("").likeness(Fingerprint.of(None))
    assert whole.likeness(Fingerprint.of("")) == 0.0 == Fingerprint.of("a").likeness(Fingerprint.of("b"))


def brute(rows):
    """(n_chars, edited digest, fingerprints, likenesses) by id, in the order of ids."""
    rows = sorted(rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        text, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        new = edited(text, after)
        a, b = Fingerprint.of(text), Fingerprint.of(new)
        out[d] = (len(text), hashlib.sha256(new.encode()).hexdigest(), str(a), str(b), a.likeness(b),
                  a.likeness(Fingerprint.of(after)))
    return out


@pytest.mark.parametrize("partitions", ["1", "4", "60"])
def test_rows_match_brute_force_at_any_partitioning(spark, table, partitions):
    rows = [r[:2] for r in edge_rows() if r[0] is not None and r[0] not in (8, 13)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: tuple(r)[1:] for r in fingerprints(
            table(rows, "doc_id long, text string"), carry=["doc_id"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(rows)


def test_edge_cases(edge, empty, table):
    out = fingerprints(edge).collect()
    assert len(out) == len(edge_rows()) and all(0.0 <= r.near_edited <= 1.0 and r.edited_sha256 for r in out)
    assert len({r.fingerprint for r in out if r.doc_id == 8}) == 1
    assert fingerprints(empty).count() == 0
    alone = fingerprints(table([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


@pytest.mark.parametrize("lines", [100, 600, 1500, 12_000])
def test_likeness_of_long_texts_follows_the_unchanged_share(lines):
    rng, found = random.Random(lines), []
    for _ in range(12):
        text, after = ("\n".join(f"{rng.getrandbits(100):030d}" for _ in range(lines)) for _ in range(2))
        own = Fingerprint.of(text)
        found.append(own.likeness(Fingerprint.of(edited(text, after))))
        assert own.likeness(Fingerprint.of(after)) < 0.35
        head, tail = text[:text.index("\n", len(text) // 2)], text[text.index("\n", len(text) // 2):]
        assert str(Fingerprint.of(head) + Fingerprint.of(tail)) == str(own)
    assert abs(sum(found) / 12 - 0.6) < 0.1 and min(found) > 0.35


@pytest.mark.parametrize("length", [1000, 8000, 200_000])
def test_a_long_line_is_more_than_one_paragraph(length):
    rng, found = random.Random(length), []
    for _ in range(12):
        text, after = ("".join(rng.choice("abcdefgh éñ中") for _ in range(length)) for _ in range(2))
        found.append(Fingerprint.of(text).likeness(Fingerprint.of(edited(text, after))))
    assert abs(sum(found) / 12 - 0.6) < 0.12 and "".join(pieces(text)) == text and pieces(text[:256]) == [text[:256]]
