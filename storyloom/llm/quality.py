"""Quality rules by distribution divergence, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import SPACE, WORD

# The commonest words of four languages with their rounded shares of running text.
COMMON_WORDS = {
    "en": {"the": .060, "of": .030, "and": .028, "to": .026, "a": .022, "in": .020, "is": .011, "that": .011, "for": .009, "it": .009, "was": .009, "on": .007},
    "de": {"der": .034, "die": .034, "und": .029, "in": .018, "den": .013, "von": .011, "zu": .011, "das": .010, "mit": .009, "sich": .008, "des": .008, "auf": .008},
    "fr": {"de": .050, "la": .028, "le": .024, "et": .021, "les": .019, "des": .017, "en": .014, "un": .012, "du": .012, "une": .011, "que": .010, "est": .009},
    "es": {"de": .062, "la": .039, "que": .030, "el": .028, "en": .026, "y": .025, "a": .020, "los": .017, "se": .013, "del": .012, "las": .011, "un": .010},
}
# Rounded shares of character classes in running prose of these languages.
CHAR_CLASSES = ("upper", "beyond_ascii", "digit", "space", "mark", "symbol", "rest")
CHAR_SHARES = {
    "en": (.026, .002, .005, .165, .021, .001, .780),
    "de": (.052, .020, .005, .138, .019, .001, .765),
    "fr": (.026, .036, .005, .160, .022, .001, .750),
    "es": (.024, .030, .005, .165, .020, .001, .755),
}
_COUNTED = {"upper": r"[A-Z]", "digit": r"[0-9]", "mark": r"[.,;:!?'\"()-]", "symbol": r"[#*$%&|<>]"}

MIN_CHARS = 200  # below, character shares say nothing
MIN_WORDS = 60  # below, shares of common words say nothing
CHARS_FAR = .30  # distance of characters that rejects alone
CHARS_OFF = .19  # distance of characters that rejects together with words that are far
WORDS_FAR = .27  # distance of words; .32 is a text without any common word


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used inside."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text, the first ones included.

    Window hashes are sorted with their places; equal neighbours mark their windows, and
    each marked window adds the words up to the next one, five at most. n log n in the text.
    """

    def covered(starts: Column) -> Column:
        last = F.size(starts) - 1
        return F.aggregate(
            F.transform(starts, lambda p, i: F.when(i == last, F.lit(5)).otherwise(F.least(F.lit(5), F.get(starts, i + 1) - p))),
            F.lit(0), lambda a, x: a + x,
        )

    def marked(pairs: Column) -> Column:
        same = lambda i, j: F.get(pairs, i)["h"].eqNullSafe(F.get(pairs, j)["h"])  # noqa: E731  get() beyond the ends is null
        return F.sort_array(F.transform(F.filter(F.transform(pairs, lambda p, i: F.struct(p["at"].alias("at"), (same(i, i - 1) | same(i, i + 1)).alias("hit"))), lambda p: p["hit"]), lambda p: p["at"]))

    def among(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(pairs, lambda p: bind(marked(p), covered)))

    def windows(h: Column) -> Column:
        n = F.size(h)
        join = lambda by: lambda x, y: F.shiftleft(x, by).bitwiseXOR(y)  # noqa: E731  each word at a shift of its own, 4 to 0 bits
        pairs = F.zip_with(F.slice(h, 1, n - 1), F.slice(h, 2, n - 1), join(1))
        fours = bind(pairs, lambda p: F.zip_with(F.slice(p, 1, n - 4), F.slice(p, 3, n - 4), join(2)))
        return F.zip_with(fours, F.slice(h, 5, n - 4), join(1))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 5, F.lit(0)).otherwise(bind(hashes, lambda h: bind(windows(h), among))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return bind(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def js_distance(shares: Column, reference: list[float]) -> Column:
    """Square root of the Jensen-Shannon divergence in bits of two distributions over the same bins."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    q = F.array(*(F.lit(float(x)) for x in reference))
    terms = F.zip_with(shares, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def split_words(text: Column) -> Column:
    """Words of a text; cutting leaves an empty first or last piece, which goes."""
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


def char_distance(text: Column, n_symbols: Column, word_chars: Column) -> Column:
    """Smallest distance of the text's character classes to those of a language.

    Characters beyond ASCII count by their extra bytes; what no class names is mostly a-z.
    """
    found = {c: F.regexp_count(text, F.lit(p)) for c, p in _COUNTED.items() if c != "symbol"}
    found |= {"beyond_ascii": F.octet_length(text) - F.length(text), "space": F.length(text) - word_chars, "symbol": n_symbols}
    counts = F.array(*(found[c].cast("double") for c in CHAR_CLASSES[:-1]), F.length(text).cast("double"))

    def shares(n: Column) -> Column:
        named = F.aggregate(F.slice(n, 1, len(CHAR_CLASSES) - 1), F.lit(0.0), lambda s, x: s + x)
        total = F.greatest(F.get(n, F.lit(len(CHAR_CLASSES) - 1)), named)
        return F.transform(n, lambda x, i: F.when(i == len(CHAR_CLASSES) - 1, total - named).otherwise(x) / total)

    normal = {k: [x / sum(v) for x in v] for k, v in CHAR_SHARES.items()}
    return bind(counts, lambda n: bind(shares(n), lambda p: F.least(*(js_distance(p, q) for q in normal.values()))))


def word_distance(words: Column) -> Column:
    """Smallest distance of the text's common words, all others as one bin, to those of a language.

    Words count as they stand between blanks, in lower case or with a capital first letter.
    """
    every = sorted({v for words in COMMON_WORDS.values() for w in words for v in (w, w.capitalize())})

    def nearest(found: Column) -> Column:
        total = F.size(words).cast("double")

        def distance(common: dict[str, float]) -> Column:
            counts = F.array(*((F.size(found) - F.size(F.array_remove(found, w))).cast("double") for w in common))
            return bind(counts, lambda n: js_distance(
                F.transform(F.concat(n, F.array(total - F.aggregate(n, F.lit(0.0), lambda s, x: s + x))), lambda x: x / total),
                [*common.values(), 1 - sum(common.values())],
            ))

        return F.least(*map(distance, COMMON_WORDS.values()))

    return bind(F.transform(F.filter(words, lambda x: x.isin(every)), lambda x: F.lower(x)), nearest)


def quality(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts, base rule and verdict of each document; one row in, one row out, no shuffle.

    A document is kept if the base rule holds and its distributions are not far from every
    language reference: characters far on their own (symbols, capitals, tables), or
    characters off and hardly any common word. Texts under ``MIN_CHARS`` or
    ``MIN_WORDS`` are not judged by the distribution that their length cannot fill. Null
    and empty texts have no words and fail the base rule. Returns doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, the two distances, ``keep``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in keep if c != "doc_id"]

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            F.when(F.size(w) >= MIN_WORDS, word_distance(w)).alias("word_distance"),
        )

    t = F.col("_t")
    counted = docs.select("doc_id", *kept, text.alias("_t")).withColumn("_w", bind(split_words(t), of_words))
    counted = counted.select("doc_id", *kept, "_t", "_w.*").withColumn("n_symbols", F.regexp_count(t, F.lit(_COUNTED["symbol"])).cast("long"))
    measured = counted.select(
        "doc_id", *kept, "n_words", "word_chars", "n_symbols", duplicate_lines(t).alias("n_dup_lines"), "n_repeat_words",
        F.when(F.length(t) >= MIN_CHARS, char_distance(t, F.col("n_symbols"), F.col("word_chars"))).alias("char_distance"), "word_distance",
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    chars, words = F.coalesce("char_distance", F.lit(0.0)), F.coalesce("word_distance", F.lit(0.0))
    far = (chars > CHARS_FAR) | ((chars > CHARS_OFF) & (words > WORDS_FAR))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)
