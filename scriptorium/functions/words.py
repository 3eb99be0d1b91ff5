"""Column functions over single words: stems, spellings, edit distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings, doubled letters, words that are not searched for, and least lengths.
SUFFIXES = ("ing", "ed", "es", "s", "ly")
DOUBLED = "bdgmnprtl"
STOPWORDS = "a an and are as at be by for from he his in is it of on or that the to was who with".split()
MIN_FUZZY, LONG_WORD = 4, 7


def is_latin(w: Column) -> Column:
    return w.rlike("^[a-z]+$")


def undoubled(stem: Column) -> Column:
    """A consonant that English doubles before an ending loses its double, unless the stem is short."""
    last, n = F.substring(stem, -1, 1), F.length(stem)
    twice = (n >= 2) & (last == F.substring(stem, -2, 1)) & last.isin(*DOUBLED)
    return F.when(twice & F.when(last == "l", n >= 7).otherwise(n >= 4), F.substring(stem, F.lit(1), n - 1)).otherwise(stem)


def stem(w: Column) -> Column:
    """The word without its first matching ending, null if it has none or would leave under four letters."""
    out = F.lit(None).cast("string")
    n = F.length(w)
    for s in reversed(SUFFIXES):
        out = F.when(w.endswith(s) & (n - len(s) >= 4), undoubled(F.substring(w, F.lit(1), n - len(s)))).otherwise(out)
    return F.when((n >= 5) & is_latin(w), out)


def variant(w: Column) -> Column:
    """The British spelling of an American one and the reverse, null if there is none."""
    n = F.length(w)
    swap = lambda end, new: F.concat(F.substring(w, F.lit(1), n - len(end)), F.lit(new))
    out = F.when((n >= 6) & w.endswith("our"), swap("our", "or")).when((n >= 5) & w.endswith("or"), swap("or", "our"))
    return F.when(is_latin(w), out.when((n >= 6) & w.endswith("ise"), swap("ise", "ize")).when((n >= 6) & w.endswith("ize"), swap("ize", "ise")))


def letter_mask(w: Column) -> Column:
    """A bit for each letter a to z that occurs."""
    bits = [F.when(w.contains(c), 1 << i).otherwise(0) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    return sum(bits[1:], bits[0])


def bounded_distance(a: Column, b: Column, limit: int) -> Column:
    """Levenshtein distance, limit + 1 where it is larger."""
    d = F.levenshtein(a, b, limit)
    return F.when(d < 0, limit + 1).otherwise(d)
