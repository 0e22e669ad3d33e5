import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from edge_cases import edge_rows
from tokenizers import Tokenizer

from rollmatch.llm import token_alignment as A

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def known():
    with open(FIRST, encoding="utf-8") as a, open(SECOND, "rb") as b:
        return A.Tokens(a.read(), b.read())


@pytest.fixture(scope="module")
def plain():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def both(plain, text):
    """Ids and bytes by the tokenizers themselves; None where the bytes differ."""
    first, second = plain
    letters = A._byte_letters()
    a = first.encode(" " + text, add_special_tokens=False)
    b = second.encode(text)
    spell = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in zip(b, second.encode(text, out_type=str))]
    spelled = [bytes(letters[c] for c in t) for t in (first.id_to_token(i) for i in a.ids)]
    raw = b" " + text.encode()
    return (list(zip(a.ids, spelled)), list(zip(b, spell))) if b"".join(spelled) == raw == b"".join(spell) else None


def brute(plain, rows):
    found, count = [], Counter()
    for doc_id, text in rows:
        two = both(plain, text) if text else None
        links, groups = [], []
        if two:
            ends = [{}, {}]
            for side, tokens in enumerate(two):
                at = 0
                for k, (_, raw) in enumerate(tokens):
                    at += len(raw)
                    ends[side][at] = k
            last = [-1, -1]
            for at in sorted(ends[0].keys() & ends[1].keys()):
                now = [ends[0][at], ends[1][at]]
                groups.append("|".join(",".join(str(t[0]) for t in two[s][last[s] + 1:now[s] + 1]) for s in (0, 1)))
                links.append((two[0][now[0]][0], two[1][now[1]][0]))
                last = now
        count.update(links)
        found.append((doc_id, two, links, ";".join(groups)))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(str((d, len(t[0]) if t else 0, len(t[1]) if t else 0, len(x), len(x), sum(count[p] == most[p[1]] for p in x),
                       sum(count[p] for p in x), hashlib.sha256(g.encode()).hexdigest() if t else "")) for d, t, x, g in found)


TEXTS = ["<|endoftext|> plain </s> <s> <unk>", "two  blanks   and\ttabs\n\n", "▁ low line", "ﬁ ½ é é  x y\u0085z",
         "漢字かな \U0001f600\U0001f468‍\U0001f469 ñandú", "x" * 3000, "9" * 700 + " 1 22 333", " lead", "trail ", "'s 'll I'd", "\x00\x01\x7f", "don't -- won't..."]


def test_ids_are_the_tokenizers(known, plain):
    rng = random.Random(1)
    odd = "aZ1é漢\U0001f600 \n\t'.- ​"
    for text in TEXTS + ["".join(rng.choice(odd) for _ in range(rng.randint(1, 60))) for _ in range(300)]:
        got, want = known.encode(text), both(plain, text)
        assert (got is None) == (want is None)
        if want:
            assert [x.tolist() for x in got] == [[t[0] for t in side] for side in want]


@pytest.mark.parametrize("seed", [1, 2])
def test_planes_hold_documents_and_multiplicities(seed):
    rng = np.random.default_rng(seed)
    pair = np.concatenate([rng.integers(0, 9, 3000), np.full(5000, 3), np.full(4096, 11)])
    slot = np.concatenate([rng.integers(0, A.CHUNK, 8000), np.arange(4096)])
    want = Counter(zip(pair.tolist(), slot.tolist()))
    pairs, planes = A.postings(pair, slot)
    got = Counter()
    for k, row, place in A.opened(planes):
        for r, p in zip(pairs[row].tolist(), place.tolist()):
            got[r, p] += 1 << k
    assert got == want
    # In two parts of different documents, merged: the same bits, documents and links.
    low = slot < 1000
    parts = [A.postings(pair[m], slot[m]) for m in (low, ~low)]
    every = np.concatenate([p[0] for p in parts])
    order = np.argsort(every, kind="stable")
    whole = A.merged(every[order], np.zeros(len(order), np.int64), pa.concat_arrays([p[1] for p in parts]).take(pa.array(order)))
    again = Counter()
    for k, row, place in A.opened(whole.column("planes")):
        for r, p in zip(whole.column("pair").to_numpy()[row].tolist(), place.tolist()):
            again[r, p] += 1 << k
    assert again == want
    per = {r["pair"]: (r["n_documents"], r["n_links"]) for r in whole.to_pylist()}
    assert per == {p: (sum(k[0] == p for k in want), sum(n for k, n in want.items() if k[0] == p)) for p in set(pair.tolist())}


def test_equals_brute_force(spark, edge, empty, plain, monkeypatch):
    rows = [r[:2] for r in edge_rows()]
    assert sorted(str(tuple(r)) for r in A.align_tokens(edge, FIRST, SECOND).collect()) == brute(plain, rows)
    assert A.align_tokens(empty, FIRST, SECOND).count() == 0
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50 + i, "the very same words the very same") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(str(tuple(r)) for r in A.align_tokens(df, FIRST, SECOND).collect()) == brute(plain, rows)


def test_parts_of_chunks_and_pairs_table(known, plain):
    rows = [(i, f"word{i % 7} the other {'again ' * (i % 5)}") for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])],
                                       names=["number", "id", "text"])

    class Sent:
        def __init__(self, value):
            self.value = value

    before, A.FLUSH_LINKS, A.TEXT_BYTES = (A.FLUSH_LINKS, A.TEXT_BYTES), 50, 100
    try:
        with open(FIRST, encoding="utf-8") as a, open(SECOND, "rb") as b:
            out = pa.Table.from_batches(list(A._scan(Sent(a.read()), Sent(b.read()))(iter([batch])))).to_pandas()
    finally:
        A.FLUSH_LINKS, A.TEXT_BYTES = before
    parts = out[out.kind == 1].sort_values(["pair", "chunk"], kind="stable")
    assert parts.duplicated(["pair", "chunk"]).any()  # several parts to merge
    table = pa.table({"pair": pa.array(parts.pair.astype("int64")), "chunk": pa.array(parts.chunk.astype("int64")),
                      "planes": pa.array(parts.planes.tolist(), pa.binary())})
    got = pa.Table.from_batches(list(A._merge(iter(table.to_batches(max_chunksize=7))))).to_pylist()
    want, docs = Counter(), Counter()
    for _, text in rows:
        a, b = both(plain, text)
        _, pair, _ = A.align(known, [(np.array([t[0] for t in a]), np.array([t[0] for t in b]))])
        want.update(pair.tolist())
        docs.update(set(pair.tolist()))
    assert {r["pair"]: (r["n_documents"], r["n_links"]) for r in got} == {p: (docs[p], want[p]) for p in want}
    assert len(got) == len(want)
