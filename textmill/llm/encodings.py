"""Problem 8: garbled text from wrong character encodings.

Learning: each token that mixes ASCII and other characters, and each token of other characters beside an ASCII one, is
keyed by itself without its non-ASCII characters (digits folded). Under a key, each variant without suspect characters may
be the clean twin of each variant with some. Of the latter all texts that a way of misreading (true code page, wrong code
page, once or twice) turns into it, in all or some of its runs of such characters, are looked up among the former; where one
is found, the way gets a vote of the key. Ways with enough votes from different keys are learned.

Applying: tokens of all texts that hold unusual characters are undone by the learned ways; a token is garbled if
one of them gives a clean word; if only parts of it can be undone (characters were lost), these parts are. Characters that
mark unreadable bytes, and C1 control characters, count as they are. Misread capitals that might be foreign words count
only beside certain damage of the same kind in the same text. In a text with certain damage, tokens that look ordinary are
undone by the ways found there: UTF-8 wherever it fits, code pages where the nearest tokens on both sides that tell are
misread the same way. Where only one side is, the token stays and the text doesn't count as complete.

Defined cases: null, empty and ASCII texts are clean; texts of any length are read as a whole; repeated rows each get
their own row; extra columns are ignored; where too few twins exist nothing is learned, and only unreadable marks,
controls and the ways in ALWAYS are found.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.scripts import EMOJI_PARTS
from textmill.session import materialize, spread

#: Keys that must vote for a way of misreading before it is learned.
LEAST_VOTES = 2
#: Code pages, by their usual names, that text was written in (besides UTF-8) or read as.
WRITTEN = ("cp1252", "cp1253", "mac_roman", "cp437", "cp850", "cp737")
READ = ("cp1252", "latin_1", "iso8859_15", "cp1250", "iso8859_2", "cp1251", "koi8_r", "cp1253", "iso8859_7", "cp1254", "cp1257", "cp437", "cp850", "cp852", "cp866", "cp737", "mac_roman", "mac_greek")
Way = tuple[str, str, int]
#: Ways so common that they need no votes.
ALWAYS: tuple[Way, ...] = (("utf_8", "cp1252", 1), ("utf_8", "latin_1", 1), ("utf_8", "cp1252", 2))
FAMILY: tuple[Way, ...] = tuple([("utf_8", r, 1) for r in READ] + [("utf_8", r, 2) for r in ("cp1252", "latin_1", "cp1253", "mac_roman")] + [(w, r, 1) for w in WRITTEN for r in READ if w != r])

_GREEK = "Ά-ώ·"
_LETTERS = "A-Za-záéíóúüñëçïÁÉÍÓÚÜÑËÇÏ"
_SIGNS = "¡¿«»“”‘’„…–—•§©®™°ºª½€£♪′″ ‍️"
#: Characters of ordinary text.
ORDINARY = re.compile(f"[\x00-\x7f{_LETTERS}Ά-ΊΌΎ-ΡΣ-ώ{_SIGNS}]+")
_STRANGE = re.compile(f"[^\x00-\x7f{_LETTERS}Ά-ΊΌΎ-ΡΣ-ώ{_SIGNS}]")
#: Places that ordinary text doesn't have, though each character may be ordinary.
_PLACES = "[a-záéíóúüñëçï][ÁÉÍÓÚÜÑËÇÏ]|[A-Za-zÀ-ɏ][Ά-ώ]|[Ά-ώ][A-Za-zÀ-ɏ]|[A-Za-zÀ-ɏ][·½¿¡£§©®](?=[A-Za-zÀ-ɏ])|[a-z]·(?![ \\w])|[BΒ]°[CF]|Β[§£©½®]|[Ά-ώ][§£©®½°«»¡¿](?=[A-Za-z])"
_MARKS = re.compile("[�\x80-\x9f]|ï¿½")
#: A text in which this finds nothing is clean.
SUSPECT = re.compile(f"{_STRANGE.pattern}|{_PLACES}")
_CUT = re.compile("[a-záéíóúñëç][ÃÂ](?=[^ A-ZÀ-ÞO]|$)|â€")
_BOTH = re.compile("[A-Za-zÀ-ɏ][Ά-ώ]|[Ά-ώ][A-Za-zÀ-ɏ]")
_LATIN_WORD = re.compile("[\x00-\x7fÀ-ɏ¡¿«»“”‘’„…–—]+")
_TOKEN = re.compile("[^ \t\r\n]+")
_OTHER = re.compile(r"[^\x00-\x7f]+")
_FOREIGN_CASE = re.compile(r"^\W*[À-ÞĀ-ɏ]")
#: Characters whose misread forms are looked for within tokens that can't be undone as a whole.
_USUAL = "áéíóúüñëçïÁÉÍÓÚÜÑËÇÏàèìòùâêîôûäöåæøœšžßÀÈÂÊÎÔÖÄÅÆØŒŠŽ¡¿«»“”‘’„…–—•§©®™°ºª½€£♪�" + "".join(map(chr, [*range(0x386, 0x3CF), *range(0x410, 0x450)]))


@cache
def _pages(name: str) -> tuple[list[str], dict[str, int]]:
    """Of a code page its characters by byte, undefined bytes as control characters, and the bytes by character."""
    chars = [bytes([b]).decode(name, "replace") for b in range(256)]
    chars = [chr(b) if c == "�" else c for b, c in enumerate(chars)]
    return chars, {c: b for b, c in reversed(list(enumerate(chars)))}


def _bytes(text: str, page: str) -> bytes | None:
    if page == "utf_8":
        return text.encode("utf-8", "surrogatepass")
    to = _pages(page)[1]
    try:
        return bytes([to[c] for c in text])
    except KeyError:
        return None


def _read(data: bytes, page: str) -> str | None:
    if page == "utf_8":
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return None
    chars = _pages(page)[0]
    return "".join([chars[b] for b in data])


def garble(text: str, way: Way) -> str | None:
    """text as misread the given way; None if it can't be."""
    for _ in range(way[2]):
        data = _bytes(text, way[0])
        text = None if data is None else _read(data, way[1])
        if text is None:
            return None
    return text


def undo(text: str, way: Way) -> str | None:
    """The text that the given way misread as text; None if there is none."""
    for _ in range(way[2]):
        data = _bytes(text, way[1])
        text = None if data is None else _read(data, way[0])
        if text is None:
            return None
    return text


_DIGITS = str.maketrans("123456789", "000000000")


def _fold(token: str) -> str:
    return token.translate(_DIGITS) if token[:1].isdigit() else token


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out: set[str] = set()
        for text in b["t"]:
            if text.isascii():
                continue
            before = ""
            for token in _TOKEN.findall(text):
                if token.isascii():
                    if before and token[0].isalnum():
                        out.add(before + " " + _fold(token))
                    before = ""
                elif re.search("[A-Za-z]", token):
                    out.add(token)
                    before = ""
                else:
                    before = token
        yield pd.DataFrame({"key": [_OTHER.sub("", v) for v in out], "variant": list(out), "bad": [SUSPECT.search(v) is not None for v in out]})


#: Runs of a garbled variant that may or may not be garbled, up to which all possible twins are listed.
MOST_OPEN = 4


def _runs(variant: str, way: Way) -> list[tuple[str, ...]]:
    """Of each run of non-ASCII characters what it may have been; empty if the way can't have garbled the variant."""
    out, any_bad = [], False
    for x in _OTHER.findall(variant):
        y = undo(x, way)
        if y == x or y is not None and garble(y, way) != x:
            y = None
        may = tuple(r for r in (y, x) if r is not None and not _STRANGE.search(r))
        if not may:
            return []
        any_bad = any_bad or y in may
        out.append(may)
    return out if any_bad else []


def _twins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of garbled variants the twins that they may have, each with its way; of those with many open runs only the shape."""
    for b in batches:
        out = []
        for key, variant in zip(b["key"], b["variant"]):
            for k, way in enumerate(FAMILY):
                runs = _runs(variant, way)
                if sum(len(r) > 1 for r in runs) > MOST_OPEN:
                    out.append((k, key, None, variant, _shape(variant)))
                    continue
                between = _OTHER.split(variant)
                for some in product(*runs) if runs else ():
                    twin = between[0] + "".join(r + a for r, a in zip(some, between[1:]))
                    if twin != variant:
                        out.append((k, key, twin, None, None))
        yield pd.DataFrame(out, columns=["way", "key", "variant", "garbled", "shape"])


def _shape(variant: str) -> str:
    return _OTHER.sub("\0", variant)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for k, key, garbled, twin in zip(b["way"], b["key"], b["garbled"], b["twin"]):
            runs = [(x, y) for x, y in zip(_OTHER.findall(garbled), _OTHER.findall(twin)) if x != y]
            if runs and all(garble(y, FAMILY[k]) == x for x, y in runs):
                out.append((k, key))
        yield pd.DataFrame(out, columns=["way", "key"])


def learn(docs: DataFrame, text: str = "text", least: int = LEAST_VOTES) -> list[Way]:
    """The ways of misreading that the twins among all texts vote for, most votes first. At most len(FAMILY) rows come to
    the driver."""
    raw = spread(docs.select(F.col(text).alias("t")).filter("t is not null")).mapInPandas(_variants, "key string, variant string, bad boolean")
    variants = materialize(raw.distinct(), "variants")
    clean = variants.filter("not bad").select("key", "variant")
    may = materialize(variants.filter("bad").mapInPandas(_twins, "way int, key string, variant string, garbled string, shape string"), "twins")
    listed = may.filter("garbled is null").select("way", "key", "variant").distinct().join(clean, ["key", "variant"], "left_semi").select("way", "key")
    shapes = clean.select("key", F.col("variant").alias("twin"), F.regexp_replace("variant", r"[^\x00-\x7f]+", "\0").alias("shape"))
    many = may.filter("garbled is not null").select("way", "key", "garbled", "shape").join(shapes, ["key", "shape"]).select("way", "key", "garbled", "twin")
    votes = listed.unionByName(many.mapInPandas(_votes, "way int, key string")).distinct().groupBy("way").count().collect()
    learned = [FAMILY[r[0]] for r in sorted(votes, key=lambda r: (-r[1], r[0])) if r[1] >= least]
    return list(dict.fromkeys([*learned, *ALWAYS]))


def _clean(token: str, plain: str | None) -> bool:
    """Whether plain, not token itself, is an ordinary word; a letter within a word is not undone to a sign."""
    if plain is None or plain == token or not ORDINARY.fullmatch(plain) or SUSPECT.search(plain):
        return False
    return len(plain) != len(token) or not any(x.isalpha() and not y.isalpha() and before.isalpha() for before, x, y in zip(token, token[1:], plain[1:]))


def _loses_letters(token: str, plain: str) -> bool:
    """Whether a letter inside a word is undone to a sign that isn't an apostrophe. At the ends of words signs may stand."""
    if len(plain) != len(token):
        return False
    inside = zip(token, token[1:], plain[1:], token[2:])
    return any(x.isalpha() and not y.isalpha() and y != "’" and a.isalpha() and z.isalpha() for a, x, y, z in inside)


def _foreign(token: str) -> bool:
    """Whether a token may be a word of a language with other letters: all its strange characters are letters, of one script, and
    its capitals stand where they may."""
    strange = _STRANGE.findall(token)
    if not strange or not all(c.isalpha() for c in strange):
        return False
    bare = "".join(c for c in token if c.isalpha())
    latin = [c < "ɐ" or "Ḁ" <= c < "ἀ" for c in bare]
    return (all(latin) or not any(latin)) and (bare[1:].islower() or bare.isupper() or not bare[1:])


class Undo:
    """Finds and undoes garbled parts of texts, by learned ways."""

    def __init__(self, ways: list[Way]) -> None:
        self.utf8 = [w for w in ways if w[0] == "utf_8"]
        self.pages = [w for w in ways if w[0] != "utf_8"]
        parts: dict[str, str] = {}
        for way in self.utf8:
            for c in _USUAL:
                x = garble(c, way)
                if x and len(x) > 1 and _STRANGE.search(x):
                    parts.setdefault(x, c)
        self.parts = parts
        self.part = re.compile("|".join(sorted(map(re.escape, parts), key=lambda p: (-len(p), p)))) if parts else re.compile("$^")

    def token(self, token: str, pages: list[Way] | None = None) -> tuple[str, str, Way | None]:
        """(kind, repaired token, way); kind: certain, lost (damage that stays), weak or clean. pages: self.pages in the order to try."""
        best = None
        for way in self.utf8:
            plain = undo(token, way)
            if plain is not None and plain != token and not _MARKS.search(plain) and self._fits(plain):
                left = len(_STRANGE.findall(EMOJI_PARTS.sub("", plain)))
                if best is None or left < best[0]:
                    best = (left, plain, way)
                if not left:
                    break
        if best:
            return "certain", best[1], best[2]
        if not _MARKS.search(token):
            mixed = _BOTH.search(token)
            for way in self.pages if pages is None else pages:
                plain = undo(token, way)
                if plain is None or plain == token or _loses_letters(token, plain):
                    continue
                if not ORDINARY.fullmatch(plain) or SUSPECT.search(plain):
                    if not (mixed and _LATIN_WORD.fullmatch(plain)):
                        continue
                return "weak" if self._doubtful(token, plain) else "certain", plain, way
        if hit := self.part.search(token):
            plain = self.part.sub(lambda m: self.parts[m[0]], token)
            return "lost" if SUSPECT.search(plain) else "certain", plain, self.utf8[0] if hit else None
        if _MARKS.search(token) or _CUT.search(token):
            return "lost", token, None
        return "clean", token, None

    def _doubtful(self, token: str, plain: str) -> bool:
        """Whether a token may be a foreign word: a strange capital at its start or in a word of capitals, or a word all in
        Cyrillic; or a sign that may mean itself."""
        if not re.search(r"\w", token):
            return re.search(r"\w", plain) is not None
        if any(not c.isalpha() for c in _STRANGE.findall(token)):
            return False
        start = bool(_FOREIGN_CASE.search(token)) and not SUSPECT.search(re.sub(r"^\W*\w", "", token))
        return start or token.isupper() or re.fullmatch(r"[\W\d]*[Ѐ-ӿ]+[\W\d]*", token) is not None

    def _fits(self, plain: str) -> bool:
        """Whether plain is what a text may hold: letters, signs and emoji, no leftovers of a misreading."""
        rest = EMOJI_PARTS.sub("", plain)
        return not re.search("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f-]", rest) and not re.search("[ÃÂ][\x80-\xbf]", plain) and all(c < "ɐ" or "Ͱ" <= c < "԰" or " " <= c < "Ⰰ" or c >= "\U0001f000" for c in rest)

    def text(self, text: str) -> tuple[bool, str, bool]:
        """(whether anything is garbled, the text as far as it can be restored, whether all of it could be)."""
        if text.isascii() or not SUSPECT.search(text):
            return False, text, True
        spans = [m for m in _TOKEN.finditer(text) if not m[0].isascii()]
        seen = {m[0]: self.token(m[0]) for m in spans if SUSPECT.search(m[0])}
        found = any(kind in ("certain", "lost") for kind, _, _ in seen.values())
        if not found:
            return False, text, True
        if not self._page_is_likely(spans, seen):
            seen = {token: ("clean", token, None) if way and way[0] != "utf_8" else (kind, plain, way) for token, (kind, plain, way) in seen.items()}
            if not any(kind in ("certain", "lost") for kind, _, _ in seen.values()):
                return False, text, True
        by_page = {token for token, (_, _, way) in seen.items() if way and way[0] != "utf_8"}
        pages = self._by_use([m[0] for m in spans if m[0] in by_page])
        utf8 = sum(seen[m[0]][2] in self.utf8 for m in spans if m[0] in seen) > sum(m[0] in by_page for m in spans)
        # among UTF-8 damage a token that holds some is a broken piece of it
        seen.update((token, self.token(token, [] if utf8 and self.part.search(token) else pages)) for token in by_page)
        ways = {way for kind, _, way in seen.values() if kind in ("certain", "lost")}
        whole = all(kind != "lost" for kind, _, _ in seen.values())
        used = Counter(seen[m[0]][2] for m in spans if m[0] in seen)
        sure = sorted((w for w in self.utf8 if w in ways), key=lambda w: -used[w])
        plains = []
        for m in spans:
            kind, plain, way = seen.get(m[0], ("ordinary", m[0], None))
            plain = plain if kind in ("certain", "lost") or way in ways else m[0]
            for w in sure:  # damage of the same kind that looks like ordinary characters
                x = undo(plain, w)
                if x is not None and x != plain and self._fits(x) and all(unicodedata.category(c) != "Cn" for c in x):
                    plain = x
                    break
            plains.append(plain)
        doubt = False
        for way in [w for w in pages if w in ways]:
            doubt = self._beside(way, spans, seen, plains) or doubt
        out, at = [], 0
        for m, plain in zip(spans, plains):
            out += [text[at : m.start()], plain]
            at = m.end()
        return True, "".join([*out, text[at:]]), whole and not doubt

    def _page_is_likely(self, spans: list[re.Match], seen: dict[str, tuple[str, str, Way | None]]) -> bool:
        """Whether the tokens that a code page undoes are damage and not words of a language with other letters: more of the
        tokens with strange letters must be undone than stay, and a single strange letter within a word of the whole text doesn't tell."""
        undone = [m[0] for m in spans if m[0] in seen and seen[m[0]][0] == "certain" and seen[m[0]][2] and seen[m[0]][2][0] != "utf_8"]
        if not undone:
            return True
        stay = sum(m[0] in seen and seen[m[0]][0] in ("clean", "weak") and _foreign(m[0]) for m in spans)
        if sum(map(_foreign, undone)) < len(undone):  # signs within words, mixed scripts: no language has these
            return True
        hurt = any(kind == "lost" or kind == "certain" and way and way[0] == "utf_8" for kind, _, way in seen.values())
        alone = len(undone) == 1 and len(_STRANGE.findall(undone[0])) == 1 and re.search(r"[^\W\d_]" + _STRANGE.pattern + r"[^\W\d_]", undone[0])
        return len(undone) >= stay and (hurt or not alone)

    def _by_use(self, tokens: list[str]) -> list[Way]:
        """The code page ways, those first that give clean words for most of tokens."""
        counts: Counter = Counter()
        for token, n in Counter(tokens).items():
            counts.update({w: n for w in self.pages if _clean(token, undo(token, w))})
        return sorted(self.pages, key=lambda w: -counts[w])

    def _beside(self, way: Way, spans: list[re.Match], seen: dict[str, tuple[str, str, Way | None]], plains: list[str]) -> bool:
        """Undoes in plains the ordinary tokens of spans that way may have given, if the nearest tokens that tell are all
        misread that way; whether any stay in doubt."""
        signs, may = [], []  # 1: misread that way, -1: not, 0: doesn't tell
        for m, plain in zip(spans, plains):
            kind, x = seen.get(m[0], ("ordinary", "", None))[0], undo(m[0], way)
            fits = _clean(m[0], x)
            may.append(x if fits and plain == m[0] and kind != "lost" else None)
            if kind == "certain":
                signs.append(1 if fits and plain == x else -1)
            else:
                signs.append(-1 if kind in ("ordinary", "lost") and not fits and x != m[0] else 0)
        near = lambda s: list(accumulate(s, lambda a, b: b or a))
        doubt = False
        for k, (x, before, after) in enumerate(zip(may, near(signs), reversed(near(signs[::-1])))):
            if x is not None and max(before, after) > 0:
                if min(before, after) < 0:
                    doubt = True
                else:
                    plains[k] = x
        return doubt


def restored(docs: DataFrame, id: str = "doc_id", text: str = "text", ways: list[Way] | None = None) -> DataFrame:
    """doc_id, text (restored as far as possible), complete: one row for each text with anything garbled."""
    ways = learn(docs, text) if ways is None else ways

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        undone = Undo(ways)
        for b in batches:
            rows = [(i, t, whole) for i, x in zip(b["doc_id"], b["t"]) for bad, t, whole in [undone.text(x)] if bad]
            yield pd.DataFrame(rows, columns=["doc_id", "text", "complete"])

    return spread(docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("t")).filter("t is not null")).mapInPandas(found, "doc_id bigint, text string, complete boolean")
