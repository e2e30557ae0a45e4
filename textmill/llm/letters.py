"""What the operators of this package take as letters, words and blanks of a text."""

from __future__ import annotations

import re
import unicodedata

_MARKS = re.compile("[̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃰︠-︯]+")
_NOT_WORD = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")


def letters(text: str | None) -> str:
    """The letters and digits of text in order, composed, in lower case, final sigma as sigma; empty for null."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    kept = _NOT_WORD.sub("", text.lower())
    if not kept.isascii():
        kept = "".join(c for c in kept if c.isalnum()).replace("ς", "σ")
    return kept


def unaccented(text: str) -> str:
    """text in lower case without accents, final sigma as sigma."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFD", text.lower())).replace("ς", "σ")


def words(text: str | None) -> list[str]:
    """The longest runs of letters and digits of text, ignoring letter case and accents."""
    return _WORD.findall(unaccented(text)) if text else []
