"""Error rates as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points that words are coded as, one each, to compare word by word: from the first, without the surrogates.
_FIRST, _SURROGATES, _END = 0x100, 0xD800, 0x110000


def chars_edited(ref: Column, hyp: Column) -> Column:
    """Characters to insert, remove or replace."""
    return F.levenshtein(F.coalesce(ref, F.lit("")), F.coalesce(hyp, F.lit("")))


def cer(ref: Column, hyp: Column) -> Column:
    """Character error rate; null for an empty reference."""
    return F.when(F.length(ref) > 0, chars_edited(ref, hyp) / F.length(ref))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")


def words_edited(ref: Column, hyp: Column) -> Column:
    """Words to insert, remove or replace: each distinct word of the pair becomes one character. A pair of more distinct words
    than there are characters, over a million, is an error."""
    a, b = words(ref), words(hyp)
    known = F.array_distinct(F.concat(a, b))
    point = lambda w: F.array_position(known, w) + F.lit(_FIRST - 1)
    free = lambda p: F.when(p < _SURROGATES, p).when(p < _END - 2048, p + 2048).otherwise(F.raise_error(F.lit("too many words")).cast("long"))
    char = lambda w: F.decode(F.unhex(F.lpad(F.hex(free(point(w))), 8, "0")), "UTF-32")
    code = lambda ws: F.array_join(F.transform(ws, char), "")
    return F.levenshtein(code(a), code(b))


def wer(ref: Column, hyp: Column) -> Column:
    """Word error rate; null for an empty reference."""
    n = F.size(words(ref))
    return F.when(n > 0, words_edited(ref, hyp) / n)


def similarity(ref: Column, hyp: Column) -> Column:
    """1 less the clipped character error rate; 0 for an empty reference."""
    return F.coalesce(1 - F.least(F.lit(1.0), cer(ref, hyp)), F.lit(0.0))
