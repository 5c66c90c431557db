"""Words, tokens and n-grams as array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. White space is listed by code point because the shorthand
# classes of regular-expression engines disagree on everything beyond ASCII.
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TOKEN = r"([\p{L}\p{N}_]{2,})"

# English function words that are left out before n-grams are
# formed, as far as a token of two or more word characters can equal them.
STOP_WORDS = """
me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very can will just don should now cannot could ought would
""".split()


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-case runs of at least two word characters, without stop words; repeats are kept."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(1))
    if not stop_words:
        return found
    return F.filter(found, lambda token: ~token.isin(list(stop_words)))


def ngrams(tokens: Column) -> Column:
    """Single tokens followed by adjacent pairs."""
    pairs = F.transform(
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda token, i: F.concat_ws(" ", F.get(tokens, i), token),
    )
    return F.concat(tokens, pairs)
