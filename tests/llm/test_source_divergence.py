import re
from collections import Counter, defaultdict

from edge_cases import edge_rows

from rollmatch.llm import source_divergence as S

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    held, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((r[1] or "", r[2] or "", r[3] or "") for r in rows):
        terms = Counter(TERM.findall(text.translate(LOWER)))
        groups.add((lang, source))
        held[lang].update(terms.keys())
        count[lang, source].update(terms)
    out = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= 3]
        sums = {s: Counter({t: count[l, s][t] for t in kept}) for l, s in groups if l == lang}
        sums[None] = sum(sums.values(), Counter())
        p = {s: {t: 1 + 1000000000 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in sums.items()}
        own, whole = p[source], p[None]
        pairs = [(-sum((own[t] - q[t]) ** 2 // q[t] for t in kept), s.encode()) for s, q in p.items() if s not in (source, None)]
        terms = [(-((own[t] - whole[t]) ** 2 // whole[t]), t.encode()) for t in kept if sums[source][t] and own[t] > whole[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def mixed_rows():
    """Two languages, one hot source, ties, one language of one source and one of texts without terms."""
    rows = [(i, f"alpha beta {'gamma ' * (i % 4)} Ünï{i % 5} x{i}y", "en", "abc"[min(i % 9, 2)]) for i in range(60)]
    rows += [(100 + i, f"alpha uno dos {'tres' * (i % 2)} É{i % 3}", "es", "ab"[i % 2]) for i in range(9)]
    return rows + [(200, "alone", "xx", "a"), (201, "123 !", "no", "a"), (202, None, "no", "b"), (203, "a\tb", "t\tg", "s")]


def test_equals_brute_force(table, edge):
    rows = mixed_rows()
    df = table(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert S.tagged_terms(df, 2).where("kind = 0").count() > 0
    assert sorted(map(tuple, S.audit(df, slices=2).collect())) == brute(rows)
    assert sorted(map(tuple, S.audit(edge).collect())) == brute(edge_rows())


def test_empty_table_and_texts_without_kept_terms(empty, table):
    assert S.audit(empty).count() == 0
    rows = [(1, "a b", "en", "s"), (2, "c", "en", "t"), (3, None, None, None)]
    df = table(rows, "doc_id long, text string, lang string, source string")
    assert sorted(map(tuple, S.audit(df).collect())) == brute(rows) == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_only_the_top_terms_and_terms_of_each_slice_once(table):
    rows = [(i, " ".join(f"w{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(20)) + (" more" if i < 4 else ""),
             "en", "ab"[i % 2]) for i in range(6)]
    df = table(rows, "doc_id long, text string, lang string, source string")
    counts, vocabulary = S.term_counts(df, slices=3)
    assert counts.select("id").distinct().count() == vocabulary.select("term").distinct().count() == vocabulary.count() == 401
    got = sorted(map(tuple, S.audit(df, top=3).collect()))
    assert got == brute(rows, top=3) and max(r[5] for r in got if r[2] == "term") <= 3


def test_layers_of_all_texts_meet(table):
    df = table(mixed_rows(), "doc_id long, text string, lang string, source string").repartition(5)
    layers = S.tagged_terms(df, 1).where("kind = 0").select("weight", "terms").cache()
    met = Counter(t for r in S._met(layers, 3).collect() for t in r.terms)
    handed = Counter(t for r in layers.collect() for t in r.terms)
    assert met == {t: min(n, 3) for t, n in handed.items()} and max(handed.values()) > 3


def test_sums_of_several_blocks(table, monkeypatch):
    words = " ".join("w" + "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(17_000))
    rows = [(i, words + " waaaa" * i, "en", "ab"[i % 2]) for i in range(4)] + [(9, "waaaa", "en", None)]
    packed = []
    monkeypatch.setattr(S, "_summed", lambda made, number, held=S._summed: packed.append(made) or held(made, number))
    df = table(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert sorted(map(tuple, S.audit(df, top=5).collect())) == brute(rows, top=5)
    found = packed[0].collect()
    assert {r.block for r in found} == {0, 1} and all({i >> S.BLOCK_BITS for i in r["index"]} == {r.block} for r in found)
