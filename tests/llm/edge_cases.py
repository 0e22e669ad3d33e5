"""Small document tables with the cases that every operator has to take: nulls, empty, long, tied and repeated."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, size string, shard string, "
          "piece string, spans string, score string, fingerprint string, n_lines string, words string, id string, "
          "line string, cid string, `odd name.` string")
OPEN = SCHEMA.count(",") + 1 - 5


def prose(rng: random.Random, n: int) -> str:
    made = ("".join(rng.choice(("the", "ing", "er", "on", "at", "re", "st", "ou")) for _ in range(rng.randint(1, 4)))
            for _ in range(n))
    return " ".join(made).replace("tst", "t.\nst")


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * OPEN)


def edge_rows() -> list[tuple]:
    rng = random.Random(7)
    long_text = prose(rng, 30_000)
    shared = prose(rng, 120)
    rows = [row(1, prose(rng, 200)), row(2, None), row(3, ""), row(4, " \t\n\x0b\r "), row(None, prose(rng, 150)),
            row(None, None, None, None), row(5, "one two"), row(6, long_text), row(7, shared, None, None), row(8, shared),
            row(8, shared), row(9, shared.replace("the", "THE", 1)), row(10, "é中\U0001f600 ñandú\n" * 5, "es", "b"),
            row(11, "1" * 5000, "xx", ""), row(12, "\n" * 3000, "en", "b"), row(13, shared + " tail", "de", "b"),
            row(13, "another text of the same number", "de", "c")]
    return rows + [row(100 + i, prose(rng, 20 + 5 * i), "en", "ab"[i % 2]) for i in range(40)]
