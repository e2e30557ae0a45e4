"""Characters that stand in for others of the same look."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

# Letters of one script that look like letters of another (Unicode's confusables, the common subset).
CYRILLIC_LIKE_LATIN = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ѕ": "S", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "с": "c", "е": "e", "ѕ": "s", "һ": "h", "і": "i", "ј": "j", "ԁ": "d", "о": "o", "р": "p", "ԛ": "q", "ԝ": "w", "у": "y", "х": "x", "ѵ": "v", "ӏ": "l", "ё": "ë", "ї": "ï", "Ё": "Ë", "Ї": "Ï",
}
GREEK_LIKE_LATIN = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j", "ω": "w", "η": "n",
    "ά": "á", "ί": "í", "ό": "ó", "ύ": "ú", "Ά": "Á", "Έ": "É", "Ή": "H́", "Ί": "Í", "Ό": "Ó", "Ύ": "Ý",
}
LATIN_LIKE_GREEK = {
    "A": "Α", "B": "Β", "E": "Ε", "Z": "Ζ", "H": "Η", "I": "Ι", "K": "Κ", "M": "Μ", "N": "Ν", "O": "Ο", "P": "Ρ", "T": "Τ", "Y": "Υ", "X": "Χ",
    "a": "α", "y": "γ", "i": "ι", "k": "κ", "v": "ν", "o": "ο", "p": "ρ", "t": "τ", "u": "υ", "x": "χ", "w": "ω", "n": "η", "á": "ά", "í": "ί", "ó": "ό", "ú": "ύ", "ı": "ι", "ɩ": "ι", "ɑ": "α",
}
OTHER_LIKE_LATIN = {"ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ⅼ": "l", "ℓ": "l", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "ɪ": "i", "ʏ": "y", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s"}
CYRILLIC_LIKE_GREEK = {
    "А": "Α", "В": "Β", "Е": "Ε", "Н": "Η", "І": "Ι", "К": "Κ", "М": "Μ", "О": "Ο", "Р": "Ρ", "Т": "Τ", "У": "Υ", "Х": "Χ", "П": "Π", "Г": "Γ", "Ф": "Φ",
    "а": "α", "і": "ι", "ї": "ϊ", "о": "ο", "р": "ρ", "у": "γ", "х": "χ", "к": "κ", "т": "τ", "ѵ": "ν", "ф": "φ", "п": "π", "г": "г",
}

#: Signs that NFKC changes though they are ordinary typography.
TYPOGRAPHY = frozenset("…ªº²³¹½¼¾™℠№℃℉´¨¯¸˜‥‼⁇⁈⁉‑″′⁰⁴⅓⅔⅛₨")
_EMOJI = "\U0001f000-\U0001faff☀-➿⬀-⯿⌀-⏿‼⁉™ℹ↔-↪Ⓜ▪-◾⤴⤵〰〽㊗㊙©®"
#: Joiners, variation selectors and tags that are part of an emoji.
EMOJI_PARTS = re.compile(f"(?:[#*0-9]️?⃣|[{_EMOJI}](?:[︎️⃣\U0001f3fb-\U0001f3ff\U000e0020-\U000e007f]|‍(?=[{_EMOJI}]))*)+")
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￹-￻\x00-\x08\x0b\x0c\x0e-\x1f\x7f\U000e0000-\U000e0fff]")
SPACES = re.compile("[   -     　\u0085]")
#: A text with none of these and no word of mixed scripts is in its ordinary form.
ODD = re.compile("[ ­µıǄ-ǌǱ-ǳɐ-ʯ̀-ͯ;·ϐ-ϖϰ-ϵϹЀ-֏؜ᅟᅠ ᠋-᠎᪰-᫿ᴀ-᷿άέήίόύώΆΈΉΊΎΌΏ -‏ -  -⁯⃐-⃿℀-⅏Ⅰ-ⅿ①-⓿　ㅤﬀ-ﬆ︀-️︠-︯﻿！-￯ꜱ\U0001d400-\U0001d7ff\U000e0000-\U000e0fff\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x85]")
MIXED = re.compile("[A-Za-zÀ-ɏ][Ͱ-Ͽἀ-῿]|[Ͱ-Ͽἀ-῿][A-Za-zÀ-ɏ]")
_LATIN, _GREEK, _CYRILLIC = re.compile("[A-Za-zªºÀ-ɏḀ-ỿ]"), re.compile("[Ͱ-Ͽἀ-῿]"), re.compile("[Ѐ-ԯ]")
_INTO = {"L": {**CYRILLIC_LIKE_LATIN, **GREEK_LIKE_LATIN, **OTHER_LIKE_LATIN}, "G": {**LATIN_LIKE_GREEK, **CYRILLIC_LIKE_GREEK}}
_INTO["G"].update({c: LATIN_LIKE_GREEK[x] for c, x in OTHER_LIKE_LATIN.items() if c not in LATIN_LIKE_GREEK and x in LATIN_LIKE_GREEK})
#: Characters of no script above, by the script of a word in which they stand in for a letter; ı is a letter of its own.
_STAND_INS = {k: re.compile("[" + "".join(c for c in OTHER_LIKE_LATIN if c in v and c != "ı") + "]") for k, v in _INTO.items()}
_TABLES = {k: str.maketrans(v) for k, v in _INTO.items()}
_TOKEN = re.compile(r"\S+")


def script(text: str) -> str:
    """L, G or C: the script that most letters of text are of; empty without letters."""
    counts = {"L": len(_LATIN.findall(text)), "G": len(_GREEK.findall(text)), "C": len(_CYRILLIC.findall(text))}
    best = max(counts, key=lambda k: (counts[k], k))
    return best if counts[best] else ""


#: Kinds of compatible characters that look different from the ordinary ones.
_DIFFERENT = ("<super>", "<sub>", "<circle>", "<square>", "<fraction>")
#: A number in micro units, whose sign is meant.
MICRO = re.compile("[0-9.,/]*\u00b5[A-Za-zΩ]{0,3}[.,;:!?)]*")


@cache
def _width(c: str) -> str:
    """c in its ordinary width and style, itself if it is a sign of its own."""
    if c.isascii() or c in TYPOGRAPHY or unicodedata.decomposition(c).startswith(_DIFFERENT):
        return c
    return unicodedata.normalize("NFKC", c)


def composed(word: str) -> str:
    """word without invisible characters, its letters and digits composed and of ordinary width."""
    if word.isascii() or MICRO.fullmatch(word):
        return word
    word = EMOJI_PARTS.sub(lambda m: m[0], word) if INVISIBLE.search(word) is None else _visible(word)
    word = unicodedata.normalize("NFC", word)
    return "".join(map(_width, word))


def _visible(word: str) -> str:
    out, at = [], 0
    for m in EMOJI_PARTS.finditer(word):
        out += [INVISIBLE.sub("", word[at : m.start()]), m[0]]
        at = m.end()
    return "".join([*out, INVISIBLE.sub("", word[at:])])


def of_script(word: str, into: str) -> str | None:
    """word with the look-alikes of other scripts brought into script L or G; None if a letter has none there."""
    mapped = word.translate(_TABLES[into])
    own, others = (_LATIN, (_GREEK, _CYRILLIC)) if into == "L" else (_GREEK, (_LATIN, _CYRILLIC))
    return mapped if own.search(mapped) and not any(o.search(mapped) for o in others) else None


def scripts_of(word: str) -> str:
    return ("L" if _LATIN.search(word) else "") + ("G" if _GREEK.search(word) else "") + ("C" if _CYRILLIC.search(word) else "")


class Confusables:
    """The letters of any script that look like one of another, by the skeletons that a Unicode library gives.

    tables: by script (L, G, C) the letters that aren't of it and look like one of its letters, with that letter (of the same case, the
    first by code point).
    """

    def __init__(self, skeletons: dict[str, str]) -> None:
        scripts = {"L": _LATIN, "G": _GREEK, "C": _CYRILLIC}
        of = {c: next((k for k, s in scripts.items() if s.match(c)), "") for c in skeletons}
        self.tables: dict[str, dict[int, str]] = {k: {} for k in scripts}
        for k, table in self.tables.items():
            own: dict[tuple[str, bool], str] = {}
            for c in sorted(skeletons):
                if of[c] == k and unicodedata.normalize("NFKC", c) == c:
                    own.setdefault((skeletons[c], c.isupper()), c)
            for c, s in skeletons.items():
                if of[c] != k and (x := own.get((s, c.isupper())) or own.get((s, False))):
                    table[ord(c)] = x
            table.update({ord(c): x for c, x in _INTO.get(k, {}).items()})
        self.letters = frozenset(c for c in skeletons if not of[c] and any(ord(c) in t for t in self.tables.values()))

    def strange(self, text: str) -> bool:
        """Whether text has look-alikes that are of none of the three scripts."""
        return not self.letters.isdisjoint(text)

    def brought(self, word: str, into: str) -> str | None:
        """word with the look-alikes of all other scripts brought into script into; None if a letter has none there."""
        mapped, own = word.translate(self.tables[into]), {"L": _LATIN, "G": _GREEK, "C": _CYRILLIC}[into]
        return mapped if mapped != word and all(own.match(c) for c in mapped if c.isalpha()) else None


def unmixed(word: str, main: str, more: Confusables | None = None) -> str:
    """A composed word of mixed scripts in the one script that all its letters can be of (main, if both are possible), or of
    one script with stand-ins of none, if all its letters can be of that one. more: look-alikes beyond the common ones."""
    there = scripts_of(word)
    if more and there and (len(there) > 1 and main == "C" or more.strange(word)):
        for into in dict.fromkeys([main] * (main in there) + list(there)):
            if (mapped := more.brought(word, into)) is not None:
                return mapped
    if len(there) < 2:
        if there not in _STAND_INS or not _STAND_INS[there].search(word):
            return word
        mapped, own = of_script(word, there), _LATIN if there == "L" else _GREEK
        return mapped if mapped and all(own.match(c) for c in mapped if c.isalpha()) else word
    first = main if main in ("L", "G") else "L"
    for into in (first, "G" if first == "L" else "L"):
        if (mapped := of_script(word, into)) is not None:
            return mapped
    for into in (first, "G" if first == "L" else "L") if more else ():
        if into in there and (mapped := more.brought(word, into)) is not None:
            return mapped
    return word


def ordinary(text: str) -> str:
    """text in ordinary characters, as far as the words themselves tell."""
    if text.isascii() or not (ODD.search(text) or MIXED.search(text)):
        return text
    spaced = SPACES.sub(" ", text)
    main = script(unicodedata.normalize("NFKC", spaced))

    def word(m: re.Match) -> str:
        w = composed(m[0])
        there = scripts_of(w)
        if there == "C" and main in ("L", "G"):
            return of_script(w, main) or w
        return unmixed(w, main)

    return _TOKEN.sub(word, spaced)
