"""SQL (DuckDB) that returns the same rows as the queries that SQL can express, by the plain definitions."""

from __future__ import annotations

from rollmatch.llm.hilbert_shards import BITS, hilbert_steps
from rollmatch.llm.line_dedup import MIN_CHARS
from rollmatch.llm.quality_rules import (
    CLASSES, COMMON_WORDS, MAX_CHAR_BITS, MAX_WORD_BITS, MIN_CHARS as COMPARED_CHARS, MIN_COMPARED_WORDS, MIN_WORDS,
    REPEAT_PERCENT, SPACES, SYMBOLS,
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

# Every pair of documents that shares a shingle is compared; components are all that can be reached over links.
NEAR_DEDUP = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w
      FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
    n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
    reached AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
    roots AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
    SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN roots ON a = doc_id"""

# Lines within one edit: equal without the same character of both, or one equal to the other without a character.
LINE_DEDUP = f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
    f AS (SELECT line, length(line) AS n, min(doc_id * 1000000 + i) AS first FROM l WHERE length(line) >= {MIN_CHARS} GROUP BY line),
    d AS (SELECT line, n, first, md5(concat(n, ':', k, ':', without)) AS same, md5(without) AS without FROM (
      SELECT *, concat(left(line, k - 1), substr(line, k + 1)) AS without FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM f))),
    x AS (SELECT line, first > min(first) OVER (PARTITION BY same) AS late FROM d),
    near AS (SELECT line FROM x WHERE late UNION
      SELECT CASE WHEN d.first > s.first THEN d.line ELSE s.line END FROM d JOIN f s ON md5(s.line) = d.without AND s.n = d.n - 1),
    k AS (SELECT doc_id, l.i, l.line, coalesce(length(l.line) >= {MIN_CHARS} AND (near.line IS NOT NULL
      OR f.first <> doc_id * 1000000 + l.i), false) AS gone FROM l LEFT JOIN f ON f.line = l.line LEFT JOIN near ON near.line = l.line)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_sha256 FROM k GROUP BY doc_id"""


def _hilbert() -> str:
    """Columns x0, x1, x2 of table `cells` to `h`, each step a subquery around the one before."""
    table = "(SELECT * FROM cells)"
    known = ["x0", "x1", "x2"]
    for step in hilbert_steps(3, BITS):
        kept = [c for c in known if c not in step]
        known = [*kept, *step]
        table = f"(SELECT doc_id, size, crc, {', '.join([*kept, *(f'{v} AS {k}' for k, v in step.items())])} FROM {table})"
    return table


# A text's CRC-32 from its bytes, by the table of the reflected polynomial.
_CRC_ENTRY = "x"
for _ in range(8):
    _CRC_ENTRY = f"list_transform({_CRC_ENTRY}, lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
HILBERT_SHARDS = f"""WITH t AS (SELECT {_CRC_ENTRY} AS tab FROM (SELECT range(256) AS x)),
    b AS (SELECT doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
    c AS (SELECT doc_id, lang, source, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size - 1),
      lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda a, v: xor(a >> 8, tab[(xor(a, v) & 255) + 1])), 4294967295) AS crc FROM b, t),
    cells AS (SELECT doc_id, size, crc, ('0x' || substr(md5(coalesce(lang, '')), 1, 4))::BIGINT >> {16 - BITS} AS x0,
      ('0x' || substr(md5(coalesce(source, '')), 1, 4))::BIGINT >> {16 - BITS} AS x1,
      least(length(bin(size)), {2 ** BITS - 1})::BIGINT AS x2 FROM c),
    r AS (SELECT *, row_number() OVER (ORDER BY h, md5(concat(doc_id, '|', crc))) - 1 AS rank, count(*) OVER () AS n FROM {_hilbert()})
    SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(rank * 16 // n AS INTEGER) AS shard,
      rank - (n * (rank * 16 // n) + 15) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM r"""


def _classes() -> str:
    """Text `t` to c0, c1, ...: characters of each class, each pattern taking from what the earlier ones left."""
    table, rest = "(SELECT doc_id, lang, t, w FROM w)", "t"
    for i, pattern in enumerate(CLASSES):
        quoted = pattern.replace("'", "''")
        table = f"(SELECT *, length({rest}) - length(r{i}) AS c{i} FROM (SELECT *, regexp_replace({rest}, '{quoted}', '', 'g') AS r{i} FROM {table}))"
        rest = f"r{i}"
    return f"(SELECT *, length({rest}) AS c{len(CLASSES)} FROM {table})"


_CLASS = ", ".join(f"c{i}" for i in range(len(CLASSES) + 1))
_COMMON = ", ".join(f"len(list_filter(w, lambda x: x IN ('{w}', '{w.capitalize()}')))" for w in COMMON_WORDS)


def _bits(counts: str, shares: str) -> str:
    total = f"list_sum({counts})"
    return (f"list_sum(list_transform(list_zip({counts}, {shares}), lambda z: CASE WHEN z[1] > 0 THEN z[1] / {total} * log2(2 * z[1] / {total} "
            f"/ (z[1] / {total} + z[2])) ELSE 0 END + z[2] * log2(2 * z[2] / (z[1] / {total} + z[2])))) / 2")


QUALITY_RULES = f"""WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
    p AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM p, range(5) q(k) GROUP BY doc_id),
    c AS (SELECT doc_id, lang, t, w, [{_CLASS}]::DOUBLE[] AS c FROM {_classes()}),
    m AS (SELECT *, list_append(k, len(w) - list_sum(k))::DOUBLE[] AS m FROM (SELECT *, [{_COMMON}] AS k FROM c)),
    sums AS (SELECT lang, 'c' AS kind, i, sum(c[i]) AS n FROM m, range(1, {len(CLASSES) + 2}) r(i) WHERE len(w) >= {MIN_WORDS} AND lang IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, 'm', i, sum(m[i]) FROM m, range(1, {len(COMMON_WORDS) + 2}) r(i) WHERE len(w) >= {MIN_WORDS} AND lang IS NOT NULL GROUP BY ALL),
    ref AS (SELECT lang, kind, list((n + 0.5::DOUBLE) / total ORDER BY i) AS s FROM (
      SELECT *, sum(n + 0.5::DOUBLE) OVER (PARTITION BY lang, kind) AS total FROM sums) GROUP BY lang, kind),
    bits AS (SELECT m.doc_id, CASE WHEN length(t) >= {COMPARED_CHARS} THEN {_bits('c', 'a.s')} END AS cb,
      CASE WHEN len(w) >= {MIN_COMPARED_WORDS} THEN {_bits('m', 'b.s')} END AS wb FROM m
      JOIN ref a ON a.kind = 'c' AND (m.lang IS NULL OR a.lang = m.lang) JOIN ref b ON b.kind = 'm' AND b.lang = a.lang),
    near AS (SELECT doc_id, min(struct_pack(worst := greatest(cb, wb), cb := cb, wb := wb)) AS least FROM bits GROUP BY doc_id),
    v AS (SELECT m.doc_id, len(w) AS n_words, length(t) - c[{SPACES + 1}]::BIGINT AS word_chars, c[{SYMBOLS + 1}]::BIGINT AS n_symbols,
      len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
        - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, coalesce(least.cb > {MAX_CHAR_BITS}, false) AS odd,
      coalesce(least.wb > {MAX_WORD_BITS}, false) AS foreign_
      FROM m LEFT JOIN rep USING (doc_id) LEFT JOIN near USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed, NOT failed AND NOT odd AND NOT foreign_ AS kept
    FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS failed FROM v)"""

EXACT_DEDUP = r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
      row_number() OVER best = 1 AS kept, text_sha256 FROM d
    WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)"""

SOURCE_DIVERGENCE = rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    kept AS (SELECT lang, term, count(*) AS n FROM d GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM d GROUP BY ALL),
    total AS (SELECT lang, source, sum(c.n) AS n FROM c JOIN kept k USING (lang, term) GROUP BY ALL),
    p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        (1 + 1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT // (coalesce(t.n, 0) + v))::HUGEINT AS p,
        (1 + 1000000000 * (k.n + 1)::HUGEINT // (langs.n + v))::HUGEINT AS q
      FROM g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN total t USING (lang, source)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pairs AS (SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value::BIGINT AS value,
      CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM r QUALIFY part = 'pair' OR rank <= 200"""

ORACLES = {"op11_source_divergence": SOURCE_DIVERGENCE, "op12_exact_dedup": EXACT_DEDUP, "op3_quality_rules": QUALITY_RULES, "op6_hilbert_shards": HILBERT_SHARDS, "op8_line_dedup": LINE_DEDUP,
           "op10_minhash_near_dedup": NEAR_DEDUP}
