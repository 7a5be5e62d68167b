"""Column expressions for sentences, tokens and n-grams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from storyloom.functions.words import STOP_WORDS

# The text rules
SENTENCE = r"[^.!?]+[.!?]*"
OUTER_SPACE = " \t\n\r\f\v"
AT_MOST_ONE_TOKEN = r"^([\p{L}\p{N}]+|[^\p{L}\p{N}])?$"
ALPHABETIC = r"^\p{L}+$"
# letters only, with no digit glued to either end
WORD = r"(?<![\p{L}\p{N}])\p{L}++(?!\p{N})"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(OUTER_SPACE))


def split_sentences(text: Column) -> Column:
    """Sentences of a body text; pieces of a single token are dropped."""
    pieces = F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), strip)
    return F.filter(pieces, lambda s: ~s.rlike(AT_MOST_ONE_TOKEN))


def with_title(title: Column, sentences: Column) -> Column:
    """The title is always sentence 0, even when it is empty."""
    return F.concat(F.array(title), sentences)


def is_content_word(token: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    word = F.lower(F.trim(token))
    return word.rlike(ALPHABETIC) & ~word.isin(*stop_words)


def tokens(sentence: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lowercase alphabetic tokens in text order, without stop words."""
    stop = list(stop_words)
    words = F.regexp_extract_all(F.lower(sentence), F.lit(WORD), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def unigrams_and_bigrams(words: Column) -> Column:
    """Single tokens and pairs of neighbours of one token list."""
    count = F.size(words)
    # slice() keeps both sides equally long, so no NULL pair can arise
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(count - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(count - 1, F.lit(0))),
        lambda left, right: F.concat_ws(" ", left, right),
    )
    return F.concat(words, pairs)
