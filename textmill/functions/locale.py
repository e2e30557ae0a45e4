"""Languages, locales and display forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Old codes of languages.
OLD_CODES = {"iw": "he", "in": "id", "ji": "yi"}


def language(tag: Column) -> Column:
    """The language of a locale tag, in lower case, old codes replaced."""
    first = F.lower(F.split(F.regexp_replace(tag, "_", "-"), "-")[0])
    for old, new in OLD_CODES.items():
        first = F.when(first == old, new).otherwise(first)
    return first


def region(tag: Column) -> Column:
    """The region of a locale tag, in upper case: the first later part of two letters or three digits; null if none."""
    later = F.slice(F.split(F.regexp_replace(tag, "_", "-"), "-"), 2, 10)
    return F.upper(F.try_element_at(F.filter(later, lambda p: p.rlike("^(?:[A-Za-z]{2}|[0-9]{3})$")), F.lit(1)))


def canonical(tag: Column) -> Column:
    """lang or lang-REGION."""
    return F.concat_ws("-", language(tag), region(tag))


def size_text(n: Column) -> Column:
    """A number of bytes for people, in binary units; megabytes from 10 up are whole ones, rounded down."""
    n, mib = n.cast("long"), F.lit(1 << 20)
    # The formats and where they change.
    return F.when(n >= 1000 * mib, F.format_string("%.1f GB", n / (mib * 1024))).when(n >= 10 * mib, F.format_string("%d MB", F.shiftright(n, 20))).otherwise(F.format_string("%.1f MB", n / mib))


def chat_endpoint(url: Column) -> Column:
    """A server address with the path of its chat completions."""
    # The paths of the interface.
    bare = F.rtrim(F.regexp_replace(F.trim(url), "/+$", ""))
    return F.when(bare.endswith("/chat/completions"), bare).when(bare.endswith("/v1"), F.concat(bare, F.lit("/chat/completions"))).otherwise(F.concat(bare, F.lit("/v1/chat/completions")))
