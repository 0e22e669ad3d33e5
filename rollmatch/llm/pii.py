"""Personal data: e-mail addresses, network addresses, card and telephone numbers.

Patterns find the base spans. A character-level bidirectional LSTM with CRF transitions, trained on base spans and
rewritten forms of them, adds spans that the patterns miss (numbers without a plus, other separators).

The model reads windows of WINDOW characters, one every STRIDE. Where windows overlap, their scores of a character are
averaged, each weighing more the more centrally the character lies in it; one best label path is then found over each
connected stretch of windows, so no transition is cut by a window's end. A window without a digit or an at sign is outside
as a whole and is not read.

An added span must have its kind's form (see `plausible`) and must not touch a match that the patterns accepted. It may lie
within one that failed its check: patterns are greedy, and a card with its expiry date behind it, or two numbers in a row,
are one failed match. Of a labelled stretch that has no such form, its longest parts between blanks that have it are taken.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, unnested, with_fields
from rollmatch.llm.sequence_model import PADDING, Tagger, encode
from rollmatch.session import cut

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
SAMPLE_DOCUMENTS = 1500   # with windows, by smallest text hash: what the model is trained on
SAMPLE_WINDOWS = 12       # of each of these
STEPS, BATCH = 400, 48
EXAMPLES, MOST_FORMS = 3000, 16
MOST_PARTS = 8            # between blanks, in one added span
CELLS = 60_000            # characters whose labels are found together

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A network address can only begin where a run of digits does: what fails at its start fails within it too.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """The patterns' matches that pass their check, by kind and start."""
    good = list(_emails(text)) if "@" in text else []
    if not _SIGN.search(text):
        return good
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            good.append((1, *m.span()))
    for m in _CARD.finditer(text):
        number = _digits(m.group())
        if 13 <= len(number) <= 19 and luhn(number):
            good.append((2, *m.span()))
    if "+" in text:
        good += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return good


def plausible(kind: int, text: str) -> bool:
    """The form an added span must have."""
    digits = _digits(text)
    if kind == 0:
        return re.fullmatch(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(?: ?\.[A-Za-z0-9-]+)+", text) is not None
    if kind == 1:
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(0 < len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search("[A-Za-z]", text)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9][0-9 ./_-]*[0-9]", text) is not None
    return 9 <= len(digits) <= 15 and re.fullmatch(r"\(?[0-9][0-9 ()./-]*[0-9]", text) is not None \
        and re.search(r"[ ()./-]", text) is not None


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign."""
    last = window_count(len(text)) - 1
    found: dict[int, None] = {}
    for m in _SIGN.finditer(text):
        i = m.start()
        for k in range(max(0, -(-(i - WINDOW + 1) // STRIDE)), min(last, i // STRIDE) + 1):
            found[k * STRIDE] = None
    return sorted(found)


def window_count(length: int) -> int:
    return 1 + max(0, -(-(length - WINDOW) // STRIDE))


def stretches(starts: Sequence[int]) -> list[list[int]]:
    """Windows that overlap, in a row."""
    found: list[list[int]] = []
    for start in starts:
        if found and start - found[-1][-1] < WINDOW:
            found[-1].append(start)
        else:
            found.append([start])
    return found


# How much a window's score of a character weighs, by the character's place in the window.
_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def merged_scores(windows: Sequence[tuple[int, str]], scores: Sequence[np.ndarray]) -> np.ndarray:
    """Scores of each character of a stretch, from those of its windows (start, text)."""
    first, (start, text) = windows[0][0], windows[-1]
    total = np.zeros((start + len(text) - first, scores[0].shape[1]), dtype=np.float32)
    weight = np.zeros(len(total), dtype=np.float32)
    for (at, text), e in zip(windows, scores):
        low, n = at - first, len(text)
        total[low:low + n] += e[:n] * _WEIGHT[:n, None]
        weight[low:low + n] += _WEIGHT[:n]
    return total / weight[:, None]


def label_paths(tagger: Tagger, texts: Sequence[Sequence[tuple[int, str]]]) -> list[list[tuple[int, str, np.ndarray]]]:
    """Per text, given as its windows (start, text): (start, text, labels) of each of its stretches that has a label."""
    found: list[list[tuple[int, str, np.ndarray]]] = [[] for _ in texts]
    todo = [(i, s, w) for i, windows in enumerate(texts) for s, w in windows]
    scores: dict[tuple[int, int], np.ndarray] = {}
    for at in range(0, len(todo), 512):
        group = todo[at:at + 512]
        e = tagger.emissions(np.array([encode(w) + [PADDING] * (WINDOW - len(w)) for _, _, w in group]))
        scores.update({(i, s): x for (i, s, _), x in zip(group, e)})
    whole = []
    for i, windows in enumerate(texts):
        text_of = dict(windows)
        for run in stretches([s for s, _ in windows]):
            parts = [(s, text_of[s]) for s in run]
            text = "".join(w[:STRIDE] for _, w in parts[:-1]) + parts[-1][1]
            whole.append((i, run[0], text, merged_scores(parts, [scores[i, s] for s in run])))
    whole.sort(key=lambda x: len(x[2]))
    at = 0
    while at < len(whole):
        # Stretches of like length go together, some CELLS characters at a time.
        high = at + 1
        while high < len(whole) and (high + 1 - at) * len(whole[high][2]) <= CELLS:
            high += 1
        group = whole[at:high]
        lengths = np.array([len(t) for _, _, t, _ in group])
        e = np.zeros((len(group), lengths.max(), group[0][3].shape[1]), dtype=np.float32)
        for row, (_, _, _, x) in zip(e, group):
            row[:len(x)] = x
        for (i, start, text, _), path in zip(group, tagger.best_paths(e, lengths)):
            if path.any():
                found[i].append((start, text, path[:len(text)]))
        at = high
    return [sorted(f, key=lambda x: x[0]) for f in found]


def labelled(text: str, offset: int, spans: Sequence[Span]) -> list[int]:
    out = [0] * len(text)
    for kind, a, b in spans:
        for i in range(max(a - offset, 0), min(b - offset, len(text))):
            out[i] = 2 + 2 * kind if i + offset > a else 1 + 2 * kind
    return out


def _new_card(rng: random.Random, span: str) -> str:
    """As many digits, beginning alike, that pass the check."""
    digits = _digits(span)
    made = digits[:2] + "".join(rng.choice("0123456789") for _ in digits[3:])
    return next(made + d for d in "0123456789" if luhn(made + d))


def _rewritten(rng: random.Random, text: str, spans: Sequence[Span], offset: int) -> tuple[str, list[int]]:
    """The window with its whole spans in another form and of other digits, and its labels."""
    out, labels, at = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        a, b = a - offset, b - offset
        if a < at or b > len(text):
            continue
        span = text[a:b]
        if kind == 3:
            number = "".join(rng.choice("0123456789") for _ in range(10))
            mark = rng.choice("-. ")
            span = rng.choice([f"({number[:3]}) {number[3:6]}-{number[6:]}", mark.join((number[:3], number[3:6], number[6:])),
                               f"00{rng.randint(20, 69)} {number[:2]} {number[2:6]} {number[6:]}"])
        elif kind == 2:
            number, mark = _new_card(rng, span), rng.choice([".", "/", "_", " ", " ", "", ""])
            span = mark.join(number[i:i + 4] for i in range(0, len(number), 4))
            # What patterns swallow with a card: its expiry date or check digits, or the number once more.
            behind = rng.choice(["" if mark else " " + span, " " + span, f" {rng.randint(100, 999)}",
                                 f" {rng.randint(1, 12):02d}/{rng.randint(24, 32)}"])
        elif kind == 0 and rng.random() < 0.5:
            span = span.replace("@", " @ ")
        out += text[at:a] + span
        mine = [1 + 2 * kind] + [2 + 2 * kind] * (len(span) - 1)
        labels += [0] * (a - at) + mine
        if kind == 2 and behind:
            out += behind
            labels += [0] + (mine if behind[1:] == span else [0] * (len(behind) - 1))
        at = b
    out, labels = out + text[at:], labels + [0] * (len(text) - at)
    return out[:WINDOW], labels[:WINDOW]


def train(examples: Sequence[tuple[str, int, list[Span]]], seed: int = 1) -> Tagger | None:
    """A tagger from windows (text, offset, accepted spans of the document); None if none of them holds a span."""
    rng, ids, labels = random.Random(seed), [], []
    held = [[s for s in spans if s[1] < offset + len(text) and s[2] > offset] for text, offset, spans in examples]
    # Few windows with spans are rewritten more often.
    times = max(2, min(MOST_FORMS, EXAMPLES // max(1, sum(map(bool, held)))))
    for (text, offset, _), inside in zip(examples, held):
        forms = [(text, labelled(text, offset, inside))]
        if inside:
            forms += [_rewritten(rng, text, inside, offset) for _ in range(times)]
        for form, marks in forms:
            fill = WINDOW - len(form)
            ids.append(encode(form) + [PADDING] * fill)
            labels.append(marks + [0] * fill)
    if not any(map(any, labels)):
        return None
    tagger = Tagger(seed)
    tagger.train(np.array(ids), np.array(labels), STEPS, BATCH, seed=seed)
    return tagger


def fitting(kind: int, text: str) -> list[tuple[int, int]]:
    """The text itself if it has the kind's form; else its longest parts between blanks that have it, from the left."""
    low, high = 0, len(text)
    while low < high and not (text[low].isalnum() or text[low] == "("):
        low += 1
    while high > low and not text[high - 1].isalnum():
        high -= 1
    if high == low or plausible(kind, text[low:high]):
        return [(low, high)] if high > low else []
    parts = [(m.start() + low, m.end() + low) for m in re.finditer(r"[^ ,;:]+", text[low:high])]
    found, at = [], 0
    while at < len(parts):
        for end in range(min(len(parts), at + MOST_PARTS) - 1, at - 1, -1):
            if plausible(kind, text[parts[at][0]:parts[end][1]]):
                found.append((parts[at][0], parts[end][1]))
                at = end
                break
        at += 1
    return found


def added_spans(labels: Sequence[tuple[int, str, np.ndarray]], taken: Sequence[Span]) -> list[Span]:
    """Spans of the labelled stretches (start, text, labels) of a text that have their kind's form and touch nothing taken."""
    blocked = sorted((a, b) for _, a, b in taken)
    out = []
    for start, text, path in labels:
        inside = np.flatnonzero(path)
        firsts = np.flatnonzero(np.concatenate([[True], np.diff(inside) > 1]))
        for low, high in zip(firsts.tolist(), [*firsts[1:].tolist(), len(inside)]):
            a, b = int(inside[low]), int(inside[high - 1]) + 1
            # The kind that most labels name and whose form there is.
            for kind in (int(k) for k in np.argsort(-np.bincount((path[a:b] - 1) // 2, minlength=len(KINDS)), kind="stable")):
                if (kind == (path[a:b] - 1) // 2).any() and (parts := fitting(kind, text[a:b])):
                    out += [(kind, x + a + start, y + a + start) for x, y in parts
                            if not any(p < y + a + start and x + a + start < q for p, q in blocked)]
                    break
    return out


def spelled(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _flat(spans: Sequence[Span]) -> list[int]:
    return [x for s in spans for x in s]


def _spans(flat: Sequence[int]) -> list[Span]:
    return list(zip(flat[::3], flat[1::3], flat[2::3]))


_FOUND = "good array<bigint>, starts array<bigint>, windows array<string>"


def _scan(docs: DataFrame, carry: Sequence[str], text_col: str) -> DataFrame:
    """Carried columns under ROW, h (hash of the text), and what the patterns and the windowing find in the whole text."""
    own = F.struct(*[F.col(quoted(c)) for c in carry])
    rows = docs.select(own.alias(ROW), F.xxhash64(docs[text_col]).alias("h"), docs[text_col].alias("t"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = pa.list_(pa.int64())
        for batch in batches:
            good, starts, windows = [], [], []
            for value in batch.column("t"):
                text = value.as_py() or ""
                at = window_starts(text)
                good.append(_flat(base_spans(text)))
                starts.append(at)
                windows.append([text[s:s + WINDOW] for s in at])
            yield pa.RecordBatch.from_pydict({
                ROW: batch.column(ROW), "h": batch.column("h"), "good": pa.array(good, numbers), "starts": pa.array(starts, numbers),
                "windows": pa.array(windows, pa.list_(pa.string()))})

    return rows.mapInArrow(scanned, with_fields(rows, [ROW, "h"], _FOUND))


def fit(scanned: DataFrame) -> Tagger | None:
    """A tagger from a bounded sample of a written scan; the driver sees SAMPLE_DOCUMENTS * SAMPLE_WINDOWS windows at most."""
    def first(name: str):
        return F.slice(name, F.lit(1), F.lit(SAMPLE_WINDOWS)).alias(name)

    # Hashes alone are ranked first, so what each task sends is a few numbers.
    found = scanned.filter(F.size("starts") > 0)
    last = [r.h for r in found.select("h").distinct().orderBy("h").limit(SAMPLE_DOCUMENTS).collect()][-1:]
    if not last:
        return None
    # Of the accepted spans, all that begin before the last window of the sample ends.
    near = F.expr(f"""CASE WHEN size(good) > 0 THEN flatten(transform(filter(sequence(0, size(good) div 3 - 1),
        i -> good[3 * i + 1] < starts[least(size(starts), {SAMPLE_WINDOWS}) - 1] + {WINDOW}), i -> slice(good, 3 * i + 1, 3)))
        ELSE good END""").alias("good")
    sample = (found.filter(F.col("h") <= last[0]).dropDuplicates(["h"])
              .select("h", near, first("starts"), first("windows")).orderBy("h").collect())
    return train([(w, s, _spans(r.good)) for r in sample for s, w in zip(r.starts, r.windows)])


def find_personal_data(docs: DataFrame, carry: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """Every input row with n_email, n_ip, n_card, n_phone (long: all spans), base_sha256 and spans (string).

    Spans are kind:start:end in code points, by kind, then start; base_sha256 is the digest of those that the patterns
    found. A null text is an empty one, without spans. Repeated rows get the same spans. Result columns replace those
    of the same name; an empty table gives none. carry: input columns to return, all by default.
    """
    table = cut(_scan(docs, carry or docs.columns, text_col))
    tagger = fit(table)

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [dict(zip(("good", "starts", "windows"), r)) for r in zip(
                *(batch.column(c).to_pylist() for c in ("good", "starts", "windows")))]
            paths = label_paths(tagger, [list(zip(r["starts"], r["windows"])) for r in rows]) if tagger else [[] for _ in rows]
            counts = np.zeros((len(rows), len(KINDS)), dtype=np.int64)
            digests, spans = [], []
            for i, r in enumerate(rows):
                good = _spans(r["good"])
                more = added_spans(paths[i], good)
                for kind, _, _ in good + more:
                    counts[i, kind] += 1
                digests.append(hashlib.sha256(spelled(good).encode()).hexdigest())
                spans.append(spelled(good + more))
            yield pa.RecordBatch.from_pydict({
                ROW: batch.column(ROW), **{f"n_{k}": pa.array(counts[:, j]) for j, k in enumerate(KINDS)},
                "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string())})

    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    more = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    out = table.drop("h").mapInArrow(tagged, with_fields(table, [ROW], more))
    return unnested(out, *names)
