"""Text expressions. Each takes and returns a Column and stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecshelf.constants import BRACKET_SPAN, MARKERS, WHITESPACE

# Chinese characters: extension A, the main block, compatibility, and the supplementary planes.
HAN = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}"
_FIRST_HAN = "㐀"
_PAIRS = rf"(?=([{HAN}]{{2}}))"
# A run of letters and digits that are not Chinese (the plain ones named first, which is faster),
# or a run of Chinese characters.
_RUN = rf"[a-z0-9[\p{{L}}\p{{N}}&&[^{HAN}]]]++|[{HAN}]++"


def remove_markers(text: Column, markers: Sequence[str] = MARKERS) -> Column:
    """Remove each marker literally, in list order."""
    return reduce(lambda c, marker: F.replace(c, F.lit(marker), F.lit("")), markers, text)


def strip_unicode(text: Column) -> Column:
    """Strip the white space that Python's `str.strip` strips (`trim` knows ASCII blanks only)."""
    return F.regexp_replace(text, rf"\A{WHITESPACE}+|{WHITESPACE}+\z", "")


def remove_bracket_spans(text: Column) -> Column:
    """Find all bracket spans, then remove each found span literally, one after the other.

    One removal may break a later span apart, which then stays: `[a](x)[b[a]]` gives `(x)[b]`.
    `text` is used several times: pass a column, not an expression.
    """
    spans = F.regexp_extract_all(text, F.lit(BRACKET_SPAN), F.lit(0))
    removed = F.aggregate(spans, text, lambda acc, span: F.replace(acc, span, F.lit("")))
    return F.when(F.contains(text, F.lit("[")), removed).otherwise(text)


def runs(text: Column, lower: bool = True) -> Column:
    """Runs of letters and digits; Chinese runs are kept apart from others."""
    return F.regexp_extract_all(F.lower(text) if lower else text, F.lit(_RUN), F.lit(0))


def split_chinese(words: Column) -> Column:
    """Replace each Chinese run by its overlapping two-character pieces, in place.

    A single character has none. `words` is used several times: pass a column, not an expression.
    """

    def pieces(word: Column) -> Column:
        pairs = F.regexp_extract_all(word, F.lit(_PAIRS), F.lit(1))
        return F.when(F.regexp_like(word, F.lit(rf"\A[{HAN}]")), pairs).otherwise(F.array(word))

    # Most text has no character from the first Chinese one on; a byte comparison tells.
    maybe = F.exists(words, lambda w: w >= _FIRST_HAN)
    return F.when(maybe, F.flatten(F.transform(words, pieces))).otherwise(words)


def keep_tokens(tokens: Column, min_len: int = 2, stopwords: Iterable[str] = ()) -> Column:
    """Keep tokens of at least `min_len` code points that are no stopword; repeats stay."""
    words = list(stopwords)

    def keep(token: Column) -> Column:
        long_enough = F.length(token) >= min_len
        return long_enough & ~token.isin(words) if words else long_enough

    return F.filter(tokens, keep)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def record_key(prefix: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(prefix), *[p.cast("string") for p in parts])


def hash_number(*parts: Column) -> Column:
    """The first eight hex digits of the md5 of the parts joined by `:`, as a number below 2^32."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
