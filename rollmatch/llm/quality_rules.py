"""Quality rules by divergence from language references. DataFrame functions only.

A document is compared with the reference of its own language twice: its character classes and its common words, each
as a histogram, by Jensen-Shannon divergence in bits (0: equal, 1: nothing shared). A histogram of few characters or
words says little, so each comparison is made only from a minimum length on.

References are sums over all documents of a labelled language; they are one row per language, and are joined on the
language. A document without a label is compared with every language's reference, all in one array, and is judged by
the language that it comes nearest to. Documents without a label make no reference: a mixture of languages is like none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, unnested, words
from rollmatch.session import cut

# Frequent function words of four languages.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "are", "with",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "ein",
    "de", "la", "le", "et", "les", "des", "un", "une", "que", "du",
    "el", "los", "del", "las", "por", "con", "se", "para",
)
# Character classes, taken off one after the other; what no pattern takes is the last class.
CLASSES = ("[a-z]+", r"[ \t-\r]+", r"[^\x00-\x7F]+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\-]+", "[#*$%&|<>]+")
SPACES, SYMBOLS = 1, 6

SENT = 4096             # references sent to the tasks at a time
MIN_WORDS = 10          # fewer words fail
REPEAT_PERCENT = 20     # a larger share of words in repeated five-word windows fails
WINDOW = 5
MIN_CHARS = 400         # from here on the character classes are compared
MIN_COMPARED_WORDS = 100  # from here on the common words are compared
MAX_CHAR_BITS = 0.07
MAX_WORD_BITS = 0.07


def _class_counts(df: DataFrame) -> DataFrame:
    """Column `classes`: characters of each class. Each pattern scans only what the earlier ones left."""
    rest, counts = "__t", []
    for i, pattern in enumerate(CLASSES):
        df = df.withColumn(f"__r{i}", F.regexp_replace(rest, pattern, ""))
        df = df.withColumn(f"__c{i}", F.length(rest) - F.length(f"__r{i}"))
        counts.append(f"__c{i}")
        rest = f"__r{i}"
    df = df.withColumn("classes", F.array(*[F.col(c).cast("long") for c in counts], F.length(rest).cast("long")))
    return df.drop(*[f"__r{i}" for i in range(len(CLASSES))], *counts)


def _common_counts(df: DataFrame) -> DataFrame:
    """Column `common`: occurrences of each common word, then all other words."""
    spellings = sorted({s for w in COMMON_WORDS for s in (w, w.capitalize())})
    df = df.withColumn("__hits", F.filter("__w", lambda w: w.isin(*spellings)))
    df = df.withColumn("__low", F.transform("__hits", lambda w: F.lower(w)))
    return df.withColumn("common", F.array(
        *[(F.size("__low") - F.size(F.array_remove("__low", w))).cast("long") for w in COMMON_WORDS],
        (F.size("__w") - F.size("__low")).cast("long"))).drop("__hits", "__low")


def _repeats(df: DataFrame) -> DataFrame:
    """Columns `n_dup_lines` and `n_repeat_words`; windows are compared by 64-bit hashes of five word hashes."""
    parts = ", ".join(f"get(__h, i + {k})" for k in range(WINDOW))
    df = (df.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^ \t-\r]")))
          .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
          .withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
          .withColumn("__g", F.expr(f"CASE WHEN size(__h) >= {WINDOW} THEN transform(sequence(0, size(__h) - {WINDOW}), "
                                    f"i -> xxhash64({parts})) ELSE array() END"))
          # Most texts repeat no window and stop here.
          .withColumn("__s", F.expr("CASE WHEN size(array_distinct(__g)) < size(__g) "
                                    "THEN sort_array(transform(__g, (g, i) -> struct(g AS g, i AS i))) END"))
          .withColumn("__p", F.expr("sort_array(transform(filter(__s, (x, k) -> x.g <=> get(__s, k - 1).g "
                                    "OR x.g <=> get(__s, k + 1).g), x -> x.i))"))
          .withColumn("n_repeat_words", F.expr(
              f"coalesce(aggregate(transform(__p, (p, k) -> least({WINDOW}, coalesce(get(__p, k + 1) - p, {WINDOW}))), "
              "0L, (a, x) -> a + x), 0L)")))
    return df.drop("__lines", "__h", "__g", "__s", "__p")


def features(docs: DataFrame, carry: Sequence[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The carried columns under ROW, with `lang`, `chars`, the histograms `classes` and `common`, and the counts."""
    own = F.struct(*[F.col(quoted(c)) for c in carry or docs.columns])
    df = docs.select(own.alias(ROW), F.coalesce(docs[text_col], F.lit("")).alias("__t"),
                     docs[lang_col].cast("string").alias("lang"))
    df = _repeats(_common_counts(_class_counts(df.withColumn("__w", words(F.col("__t"))))))
    return df.select(ROW, "lang", F.length("__t").alias("chars"), "classes", "common",
                     F.size("__w").cast("long").alias("n_words"),
                     (F.length("__t") - F.get("classes", F.lit(SPACES))).cast("long").alias("word_chars"),
                     F.get("classes", F.lit(SYMBOLS)).alias("n_symbols"), "n_dup_lines", "n_repeat_words")


def language_references(counted: DataFrame) -> DataFrame:
    """One row per language: smoothed shares of character classes and common words over all its documents.

    counted: a table of features. A document of fewer than MIN_WORDS words, or of null language, adds nothing. Sums
    combine before the shuffle.
    """
    def shares(histogram: str, share: str) -> DataFrame:
        bins = counted.filter((F.col("n_words") >= MIN_WORDS) & F.col("lang").isNotNull()).select(
            "lang", F.posexplode(histogram).alias("bin", "n"))
        sums = bins.groupBy("lang", "bin").agg(F.sum("n").alias("n")).groupBy("lang").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("bin", "n"))), lambda x: x["n"] + F.lit(0.5)).alias("v"))
        return sums.select("lang", F.expr("transform(v, x -> x / aggregate(v, 0D, (a, y) -> a + y))").alias(share))

    known = shares("classes", "class_shares")
    other = shares("common", "common_shares").withColumnRenamed("lang", "other")
    return known.join(other, F.col("lang") == F.col("other")).drop("other").withColumnRenamed("lang", "known")


def _divergence(counts: str, shares: str) -> str:
    """Jensen-Shannon divergence, in bits, of the counts' shares and the reference's."""
    return (f"aggregate(zip_with(transform({counts}, c -> c / __total), {shares}, (p, q) -> "
            "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0D END + q * log2(2 * q / (p + q))), 0D, "
            "(a, x) -> a + x) / 2".replace("__total", f"aggregate({counts}, 0L, (a, c) -> a + c)"))


def _bits(reference: str) -> tuple[str, str]:
    """char_bits and word_bits against a reference (a prefix of its columns), null where too short to compare."""
    return (f"CASE WHEN chars >= {MIN_CHARS} THEN {_divergence('classes', reference + 'class_shares')} END",
            f"CASE WHEN n_words >= {MIN_COMPARED_WORDS} THEN {_divergence('common', reference + 'common_shares')} END")


def _judged(docs: DataFrame, carry: Sequence[str] | None, text_col: str, lang_col: str) -> DataFrame:
    counted = cut(features(docs, carry, text_col, lang_col))  # read for the references, then for the verdicts
    refs = cut(language_references(counted))
    # Languages are few: the references are sent to the tasks once their number is known to be small.
    n_refs = refs.count()
    sent = F.broadcast(refs) if n_refs <= SENT else refs
    char, word = _bits("")
    labelled = (counted.filter("lang IS NOT NULL").join(sent, F.col("lang") == F.col("known"), "left")
                .select(*counted.columns, F.expr(char).alias("char_bits"), F.expr(word).alias("word_bits")))
    # The nearest language is that whose larger divergence is smallest: if any passes both limits, it does.
    char, word = _bits("r.")
    least = (f"array_min(transform(transform(refs, r -> struct({char} AS char, {word} AS word)), "
             "b -> struct(greatest(b.char, b.word) AS worst, b.char, b.word)))")
    unlabelled = counted.filter("lang IS NULL")
    # All references meet a document, SENT at a time: one row of them, of bounded size, is sent to the tasks.
    parts = max(1, -(-n_refs // SENT))
    for i in range(parts):
        some = refs.filter(F.pmod(F.xxhash64("known"), F.lit(parts)) == i)
        row = F.broadcast(some.agg(F.collect_list(F.struct("known", "class_shares", "common_shares")).alias("refs")))
        unlabelled = unlabelled.crossJoin(row).withColumn(f"least{i}", F.expr(least)).drop("refs")
    unlabelled = unlabelled.withColumn("least", F.array_min(F.array(*[f"least{i}" for i in range(parts)]))).select(
        *counted.columns, F.col("least.char").alias("char_bits"), F.col("least.word").alias("word_bits"))
    df = labelled.unionByName(unlabelled)
    return (df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("char_bits", F.lit(0.0)) <= MAX_CHAR_BITS)
                        & (F.coalesce("word_bits", F.lit(0.0)) <= MAX_WORD_BITS)))


def judge(docs: DataFrame, carry: Sequence[str] | None = None, text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """Every input row with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), char_bits, word_bits
    (double, null where too short to compare), base_failed and kept (boolean).

    A null text is an empty one: no words, base_failed. A document of null language gets the divergences from the
    language it is nearest to; if no document has a language, there is nothing to compare with (both null). Repeated
    rows are judged alike; a column of a result's name is replaced; an empty table gives none.
    carry: input columns to return, all by default.
    """
    return unnested(_judged(docs, carry, text_col, lang_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "char_bits", "word_bits", "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The input rows that the rules keep, with the input's columns only."""
    return _judged(docs, None, text_col, lang_col).filter("kept").select(f"{ROW}.*")
