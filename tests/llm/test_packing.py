import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge_cases import edge_rows
from tokenizers import Tokenizer

from rollmatch.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_ids_equal_the_tokenizer(tokenizer):
    texts = [r[1] or "" for r in edge_rows()] + [
        "a<|endoftext|>b I'll don't é Σς ΑΣ x\x1cy a b İstanbul é. ..,. 12.5 ǅ ﬁ 漢字, क्षि \U0001d400x"]
    for text, ids in zip(texts, P.WordIds(PATH).of(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_in_few_sequences(seed):
    rng = random.Random(seed)
    counts = Counter(min(P.SEQUENCE, 1 + int(rng.lognormvariate(6.5, 1.2))) for _ in range(3000 * 10 ** (seed % 2)))
    groups = P.plan_groups(counts)
    held = Counter()
    for n, lengths in groups:
        assert sum(lengths) <= P.SEQUENCE
        for x in lengths:
            held[x] += n
    assert held == counts
    least = -(-sum(k * n for k, n in counts.items()) // P.SEQUENCE)
    assert sum(n for n, _ in groups) <= 1.02 * least + 1


def test_plans_of_no_pieces_and_of_one_length():
    assert P.plan_groups({}) == [] and P.plan_runs({}).shape == (0, 4)
    assert sum(n for n, _ in P.plan_groups({2048: 11})) == 6
    assert sum(n for n, _ in P.plan_groups({4096: 5, 1: 4096})) == 6


def test_packed_pieces_are_whole_and_gapless(edge, empty, tokenizer):
    got = P.pack_documents(edge, PATH, with_ids=True).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.length
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= P.SEQUENCE
    for doc_id, text in ((r[0], r[1]) for r in edge_rows() if r[0] not in (None, 8, 13)):
        rows = sorted(documents[doc_id], key=lambda r: r.piece)
        assert [x for r in rows for x in r.ids] == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert [r.start for r in rows] == [P.SEQUENCE * i for i in range(len(rows))]
    assert len([r for r in got if r.piece == 0]) == len(edge_rows())
    assert P.pack_documents(empty, PATH).count() == 0
