"""Problem 3: broken prompt and response pairs.

Each pair gets at most one defect: empty, refusal, other_language, copy or truncated, in this order.

copy: the response, with its prompt as a zstandard dictionary, compresses to next to nothing, and the prompt was not
clean already. refusal and other_language use dictionaries: phrases that decline, and the words that are usual in one
language only, which are learned from all inputs. truncated looks at the end of the response: an end inside a word or
after a sign that opens something, in light mode an end of the input that is missing, and where only the final stop is
missing, a model of the words that end a message, learned from all outputs.

All rows are counted, and the counts of words and ends stay tables: each pair is judged once without them, and the few
whose defect depends on words or ends are judged again with what the tables know of theirs. Executors and driver hold
what the rules and alphabets bound only.

Defined cases: a null output is empty; a null or blank input leaves only empty and refusal possible; null modes are
taken as rambler; very long texts are handled whole; unknown languages have no hesitations but those of all
languages; repeated rows each get their own row; extra columns are ignored.
"""

from __future__ import annotations

import difflib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.llm.letters import unaccented, words
from textmill.llm.scripts import ordinary
from textmill.session import materialize, spread

#: Counts that a task holds before it hands them on.
MOST_COUNTS = 200_000
#: Most languages in the rules.
MOST_RULES = 1000
#: A word belongs to a language if it has at least this share of the word's texts there.
PURITY = 0.9
#: Words of a refusal to each phrase that declines or word about requests, at most.
REFUSAL_PER = 16
#: Three letters in a row that a language needs before its looks are judged, and how many deviations from them are strange.
LEAST_LOOKS, STRANGE = 2000, 5.0
#: Words of an output that count as its end.
END_WORDS = 4
#: Texts that a word must stand in, and times that an end must be seen.
LEAST_TEXTS = 5

# Outputs that stand for nothing, without signs.
NOTHING = frozenset("n a|na|none|null|nil|nan|no text|empty|blank|no output|output|no response|no answer|nothing|undefined|no content|tbd|text|placeholder|silence|inaudible|no speech|no message|no input|no result|not available|not applicable|empty message|empty output|empty response|no output generated|insert text here|message|σιωπη|κενο μηνυμα|καμια απαντηση|heshtje|mesazh bosh|pa pergjigje|silencio|mensaje vacio|sin respuesta|sin mensaje|χωρισ κειμενο|κενο|τιποτα|κανενα κειμενο|pa tekst|bosh|asgje|sin texto|vacio|nada|ninguno|sin salida|kein text|leer|vide|vuoto".split("|"))
# Phrases that decline (unaccented, one blank between words).
DECLINES = (
    "can t help|cannot help|can not help|can t assist|cannot assist|unable to|not able to|won t be able|will not be able|must decline|have to decline|need to decline|decline to|not possible for me|cannot produce|can t produce|cannot provide|can t provide|can t comply|cannot comply|cannot rewrite|can t rewrite|cannot fulfill|can t fulfill|cannot process|can t process|not allowed to|not permitted to|i refuse|as an ai|as a language model|as an assistant|against my guidelines|my guidelines|can t do that|cannot do that|cannot continue|can t continue|not comfortable|"
    "δεν μπορω να|αδυνατω να|δεν μου επιτρεπεται|δεν γινεται να|δεν ειμαι σε θεση|πρεπει να αρνηθω|αρνουμαι να|ωσ βοηθοσ|τουσ κανονεσ μου|δεν επιτρεπεται να|ειναι αδυνατο να|"
    "nuk mund ta|nuk mund te ndihmoj|nuk mund te|nuk me lejohet|nuk jam ne gjendje|duhet ta refuzoj|duhet te refuzoj|refuzoj|si asistent|rregullat e mia|e pamundur per mua|nuk jam i autorizuar|"
    "no puedo ayudar|no puedo|no estoy autorizado|no estoy autorizada|debo negarme|me niego a|no me es posible|no soy capaz|incumple mis normas|mis normas|como asistente|no me esta permitido|no estoy en condiciones|"
    "ich kann nicht|kann ich nicht|kann ich leider nicht|nicht moglich|nicht in der lage|ich darf nicht|muss ich ablehnen|als ki|je ne peux pas|je suis desole|je ne suis pas en mesure|je refuse|non posso|non sono in grado|mi dispiace ma|nao posso|nao consigo|desculpe mas|"
    "nie moge|nie jestem w stanie|nie wolno mi|musze odmowic|odmawiam|nemohu|nemuzu|nejsem schopen|musim odmitnout|nemozem|ik kan niet|kan ik niet|kan ik helaas niet|niet in staat|ik mag niet|jag kan inte|jag kan tyvarr inte|jeg kan ikke|kan jeg ikke|jeg kan desværre ikke|en voi auttaa|en pysty|"
    "nem tudok|nem segithetek|nem all modomban|nu pot|nu sunt in masura|yardimci olamam|yapamam|yerine getiremem|не могу|не в состоянии|вынужден отказать|не можу|не мога|ne mogu|ne morem"
).split("|")
# What a refusal talks about (beginnings of words, unaccented).
ABOUT = (
    "request|content|text|messag|rewrit|rephras|process|guidelin|offensiv|harmful|wording|respectful|assist|languag|help|edit|"
    "αιτημ|κειμεν|μηνυμ|διατυπ|περιεχ|κανονε|προσβλητ|επεξεργ|ξαναγρα|βοηθ|ευγεν|"
    "kerkes|tekst|mesazh|permbajt|rishkr|formul|rregull|gjuhe|fyes|ndihmoj|perpunoj|sjells|"
    "solicitud|texto|mensaje|contenido|reescrib|normas|lenguaje|ofensiv|ayudar|procesar|editar|redaccion|respetuos|formular|"
    "anfrage|inhalt|nachricht|demande|contenu|richiesta|contenuto|messaggio|pedido|conteudo|mensagem|"
    "prosb|tresc|tekst|wiadomosc|pomoc|zadost|obsah|zprav|verzoek|inhoud|bericht|begaran|innehall|meddeland|anmodning|indhold|besked|pyynto|viesti|sisalt|keres|tartalo|uzenet|szoveg|cerere|continut|mesaj|ajut|istek|isteg|talep|talebi|icerig|metn|запрос|просьб|текст|сообщен|содержан|помоч|запит|прохан|повідомлен|заявк|съобщен|помогн|zahtev|zahtjev|sadrzaj|poruk|prosnj|sporocil"
).split("|")
_DECLINES = re.compile("|".join(f"(?<!\\w){d}" for d in DECLINES))
_ABOUT = re.compile("|".join(f"(?<!\\w){a}" for a in ABOUT))
_MARKUP = re.compile(r"<think>.*?</think>|<[^<>]*>|&\w{2,8};|!?\[[^\]]*\]\([^)]*\)", re.S)
_STOP = re.compile(r"[.!?…;。！？;؟।](?:[\s\"'»”’)\]*_]|[^\w\s(\[{«“,:–—-])*$")
_DOTS = re.compile(r"\.\.\.[\s\"'»”’)]*$")
_DANGLING = re.compile(r"[,:(\[{«“–—/&+=-]\s*$")
_EMOJI = re.compile("[\U0001f000-\U0001faff☀-➿]")


@dataclass
class Model:
    """What a pair is judged by. Words' languages and ends grow with the texts; the rest is bounded by rules and alphabets."""

    fillers: list[tuple[str, ...]] = field(default_factory=list)
    filler_words: frozenset[str] = frozenset()
    loose: frozenset[tuple[str, ...]] = frozenset()  # fillers and corrections that clean texts hold too
    corrections: list[tuple[str, ...]] = field(default_factory=list)
    language: dict[str, str] = field(default_factory=dict)
    ends: dict[tuple[str, ...], float] = field(default_factory=dict)  # log odds of an end after these words
    looks: dict[str, dict[str, float]] = field(default_factory=dict)  # by language the log shares of three letters in a row
    usual: dict[str, tuple[float, float]] = field(default_factory=dict)  # mean and deviation of these over a language's own words


def _phrase(text: str, into: re.Pattern = re.compile(r"[^\W_]+")) -> tuple[str, ...]:
    return tuple(into.findall(unaccented(text)))


def _has(ws: list[str], phrase: tuple[str, ...]) -> int:
    k = len(phrase)
    if k == 1:
        return ws.count(phrase[0])
    return sum(ws[i : i + k] == list(phrase) for i in range(len(ws) - k + 1) if ws[i] == phrase[0])


@lru_cache(1 << 16)
def _shape(raw: str) -> str:
    """A word for the end model: names and numbers stand for their kind."""
    word = unaccented(raw)
    return "#" if word.isdigit() else "@" if raw[:1].isupper() and len(raw) > 4 else word


_RAW = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


def _contexts(output: str) -> tuple[list[tuple[str, ...]], list[str]]:
    raws = _RAW.findall(output)
    shapes = [_shape(r) for r in raws]
    return [tuple(shapes[max(0, i - 1) : i + 1]) for i in range(len(shapes))], raws


def _ruled(rules: DataFrame) -> Model:
    """The model that the rules alone give (four languages, one row each)."""
    model, some = Model(), rules.select("fillers", "light_fillers", "corrections").limit(MOST_RULES + 1).collect()
    if len(some) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    fillers = {_phrase(x) for r in some for x in [*(r[0] or []), *(r[1] or [])] if x}
    model.fillers = sorted((f for f in fillers if f), key=lambda f: (-len(f), f))
    model.filler_words = frozenset(w for f in fillers for w in f)
    model.corrections = sorted({p for r in some for x in r[2] or [] if x and (p := _phrase(x))}, key=lambda f: (-len(f), f))
    return model


def _counted(pairs: DataFrame, phrases: list[tuple[str, ...]], most: int = MOST_COUNTS) -> DataFrame:
    """kind, a, b, n, m over all pairs. word: n texts of language b hold the word a. end: after the word b (empty: none), a ended n
    clean outputs and stood inside them m times. held: n clean outputs hold the phrase a. clean: n outputs are clean."""
    by_first: dict[str, list[tuple[str, ...]]] = defaultdict(list)
    for f in phrases:
        by_first[f[0]].append(f)
    firsts = frozenset(by_first)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = defaultdict(Counter)
        held, ends, inside, clean = Counter(), Counter(), Counter(), 0

        def handed() -> pd.DataFrame:
            rows = [("word", w, code, k, 0) for code, c in seen.items() for w, k in c.items() if not w.isdigit()]
            rows += [("end", x[1], x[0], ends[x], inside[x]) for x in ends.keys() | inside.keys()]
            rows += [("held", " ".join(f), "", k, 0) for f, k in held.items()] + [("clean", "", "", clean, 0)]
            return pd.DataFrame(rows, columns=["kind", "a", "b", "n", "m"])

        for batch in batches:
            for lang, a, b in batch[["lang", "input", "output"]].itertuples(index=False, name=None):
                wa, wb = words(a), words(b)
                seen[lang.strip().lower()[:2]].update(set(wa))
                if wb != wa and _STOP.search(b) and not _DOTS.search(b):
                    clean += 1
                    held.update([f for w in firsts & set(wb) for f in by_first[w] if _has(wb, f)])
                    shapes = [_shape(r) for r in _RAW.findall(b)]
                    inside.update(zip(["", *shapes[:-2]], shapes[:-1]))
                    ends.update(zip(["", *shapes][-2:-1], shapes[-1:]))
                if len(ends) + len(inside) + sum(map(len, seen.values())) > most:
                    yield handed()
                    held, ends, inside, clean = Counter(), Counter(), Counter(), 0
                    seen.clear()
        yield handed()

    usable = pairs.filter("input is not null and output is not null").select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "input", "output")
    counts = spread(usable).mapInPandas(count, "kind string, a string, b string, n bigint, m bigint")
    return counts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _learned(pairs: DataFrame, rules: DataFrame) -> tuple[Model, DataFrame]:
    """The bounded part of the model, and key, lang, odds: the language of each word that has one, and the log odds of each end."""
    model = _ruled(rules)
    counts = materialize(_counted(pairs, [*model.fillers, *model.corrections]), "counts")
    some = counts.filter("kind in ('held', 'clean')").select("kind", "a", "n").collect()
    clean = sum(k for kind, _, k in some if kind == "clean")
    model.loose = frozenset(tuple(f.split(" ")) for kind, f, k in some if kind == "held" and k > max(2, clean / 500))
    seen = counts.filter("kind = 'word'").select(F.col("a").alias("word"), F.col("b").alias("code"), "n")
    threes = seen.select("code", "n", F.explode(F.expr("transform(sequence(1, length(word)), i -> substring(concat(' ', word, ' '), i, 3))")).alias("three")).groupBy("code", "three").agg(F.sum("n").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("code"))
    looks: dict[str, dict[str, int]] = defaultdict(dict)
    for code, x, k in threes.withColumn("whole", whole).filter(F.col("whole") >= LEAST_LOOKS).select("code", "three", "n").collect():
        looks[code][x] = k
    for code, c in looks.items():
        total = sum(c.values())
        model.looks[code] = {x: math.log((k + 0.1) / total) for x, k in c.items()} | {"": math.log(0.1 / total)}
        mean = math.fsum(k * model.looks[code][x] for x, k in c.items()) / total
        model.usual[code] = mean, math.sqrt(math.fsum(k * (model.looks[code][x] - mean) ** 2 for x, k in c.items()) / total)
    of = seen.groupBy("word").agg(F.sum("n").alias("n"), F.max(F.struct("n", "code")).alias("top")).filter((F.col("n") >= LEAST_TEXTS) & (F.col("top.n") >= PURITY * F.col("n")))
    ends = counts.filter("kind = 'end'").select("a", "b", "n", "m")
    ends = ends.filter("b <> ''").select(F.concat_ws(" ", "b", "a").alias("end"), "n", "m").unionByName(ends.groupBy(F.col("a").alias("end")).agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    ends = ends.filter(F.col("n") + F.col("m") >= LEAST_TEXTS).select(F.concat(F.lit(_END), "end").alias("key"), F.lit(None).cast("string").alias("lang"), F.log((F.col("n") + 0.1) / (F.col("m") + 1)).alias("odds"))
    return model, of.select(F.concat(F.lit(_WORD), "word").alias("key"), F.col("top.code").alias("lang"), F.lit(None).cast("double").alias("odds")).unionByName(ends)


#: Beginnings of the keys of words and ends.
_WORD, _END = "word ", "end "


def _knowing(model: Model, known: dict[str, str], odds: dict[str, float]) -> Model:
    """The model with languages and odds by key."""
    return replace(model, language={k.removeprefix(_WORD): lang for k, lang in known.items()}, ends={tuple(k.removeprefix(_END).split(" ")): x for k, x in odds.items()})


def learn(pairs: DataFrame, rules: DataFrame) -> Model:
    """The whole model in memory, for tables whose words the driver can hold; defects() doesn't need that."""
    model, known = _learned(pairs, rules)
    rows = known.collect()
    return _knowing(model, {k: lang for k, lang, _ in rows if lang is not None}, {k: x for k, _, x in rows if x is not None})


def _empty(output: str | None) -> bool:
    if output is None:
        return True
    bare = _MARKUP.sub(" ", output)
    ws = words(bare)
    return " ".join(ws) in NOTHING if len(ws) < 4 and ws else not ws and not _EMOJI.search(bare)


def _refusal(wb: list[str], inset: set[str]) -> bool:
    """Whether words decline: a phrase that does, and new words about requests; more of these if few words are new, and
    at any length one of either in every REFUSAL_PER words."""
    new = [w for w in wb if w not in inset]
    if 10 * len(new) < 3 * len(wb) or not (declines := _DECLINES.findall(" ".join(wb))):
        return False
    about = _ABOUT.findall(" ".join(new))
    return len(set(about)) >= (1 if 2 * len(new) >= len(wb) else 3) and (len(declines) + len(about)) * REFUSAL_PER >= len(wb)


def _other_language(model: Model, wa: list[str], wb: list[str], inset: set[str]) -> bool:
    new = [w for w in wb if w not in inset]
    if 2 * len(new) < len(wb):
        return False
    greek = lambda ws: sum("α" <= w[0] <= "ω" for w in ws) / max(1, len(ws))
    if abs(greek(new) - greek(wa)) > 0.6:
        return True
    votes = Counter(lang for w in new if (lang := model.language.get(w)))
    own = Counter(lang for w in wa if (lang := model.language.get(w)))
    if not own:
        return False
    mine = own.most_common(1)[0][0]
    if votes:
        return votes.most_common(1)[0][0] != mine
    return 5 * len(new) >= 4 * len(wb) and _looks_foreign(model, mine, new)


def _threes(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def _looks_foreign(model: Model, lang: str, ws: list[str]) -> bool:
    """Whether words that are usual in no language look less like lang than chance allows: by what three letters stand in a
    row, so that few letters need to be the stranger."""
    threes = [x for w in ws if not w.isdigit() for x in _threes(w)]
    if lang not in model.looks or not threes:
        return False
    look, (mean, deviation) = model.looks[lang], model.usual[lang]
    score = sum(look.get(x, look[""]) for x in threes) / len(threes)
    return (mean - score) * math.sqrt(len(threes)) > STRANGE * deviation


class _Zip:
    """Sizes of texts compressed with others as dictionaries."""

    def size(self, text: str, prompt: str) -> int:
        if len(prompt) < 8:
            return len(text)
        dictionary = zstandard.ZstdCompressionDict(prompt.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=1, dict_data=dictionary, write_content_size=False, write_checksum=False).compress(text.encode()))


#: A copy compresses to at most this many bytes, and one more for every COPY_PER bytes.
COPY_BYTES, COPY_PER = 28, 64


def _copy(model: Model, sizes: _Zip, output: str, wa: list[str], wb: list[str]) -> bool:
    if not 0.9 * len(wa) <= len(wb) <= 1.1 * len(wa) + 1:
        return False
    flat = " ".join(wb)
    if sizes.size(flat, " ".join(wa)) > COPY_BYTES + len(flat.encode()) / COPY_PER:
        return False
    said = [*model.fillers, *model.corrections]
    strong = [f for f in said if f not in model.loose and _has(wb, f)]
    if wb != wa:  # nearly the same: most of what a cleaned text would lack must be there
        hesitations = lambda ws: sum(_has(ws, f) for f in said if f not in model.loose) + sum(x == y for x, y in zip(ws, ws[1:]))
        return bool(strong) and hesitations(wb) >= 0.8 * hesitations(wa)
    if strong:
        return True
    weak = any(_has(wb, f) for f in model.loose) or any(x == y for x, y in zip(wb, wb[1:]))
    return weak and not any(w[:1].isupper() for w in output.split()[1:])


def _near(word: str, others: set[str]) -> bool:
    if word in others:
        return True
    return any(abs(len(o) - len(word)) <= 2 and o[:2] == word[:2] and difflib.SequenceMatcher(None, word, o).ratio() >= 0.8 for o in others)


def _tail_missing(model: Model, wa: list[str], wb: list[str]) -> int:
    """Words of the input, from its end back to one that the output ends with, that the output should hold and doesn't."""
    outset, end, missing = set(wb), set(wb[-END_WORDS:]), 0
    last = next((w for w in reversed(wa) if w not in model.filler_words), None)
    if last is None or _near(last, end):
        return 0
    for i in range(len(wa) - 1, -1, -1):
        for c in model.corrections:  # what stands before a correction is replaced by what stands after it
            if tuple(wa[max(0, i - len(c) + 1) : i + 1]) == c:
                return missing
        w = wa[i]
        if w in model.filler_words:
            continue
        if w in end:
            return missing
        missing += w not in outset and not _near(w, outset)
    return missing


def _truncated(model: Model, mode: str, output: str, wa: list[str], wb: list[str]) -> bool:
    light = mode == "light"
    if light and wa and _tail_missing(model, wa, wb):
        return True
    if light and wa and wb == wa:
        return False
    if _DANGLING.search(output):
        return True
    if _DOTS.search(output):
        return not light or not wa or wa[-1] != wb[-1]
    if _STOP.search(output):
        return False
    last, inset = wb[-1], set(wa)
    if last not in inset and any(w.startswith(last) and w != last for w in inset):
        return True
    if light and wa:
        return False
    contexts, _ = _contexts(output)
    if wa and wa[-1] == last:
        return False
    odds = model.ends.get(contexts[-1], model.ends.get(contexts[-1][-1:], -9.0)) if contexts else 0.0
    return odds < 1.5


def defect(model: Model, sizes: _Zip, mode: str | None, input: str | None, output: str | None) -> str | None:
    """The defect of one pair, or None."""
    if _empty(output):
        return "empty"
    input, output = ordinary(input or ""), ordinary(output)
    wa, wb = words(input), words(_MARKUP.sub(" ", output) if "<" in output else output)
    if not wb:
        return None
    inset = set(wa)
    novel = sum(w not in inset for w in wb) / len(wb)
    if _refusal(wb, inset):
        return "refusal"
    if not wa:
        return None
    if novel >= 0.5 and _other_language(model, wa, wb, inset):
        return "other_language"
    if novel < 0.1 and _copy(model, sizes, output, wa, wb):
        return "copy"
    return "truncated" if _truncated(model, (mode or "").strip().lower(), output, wa, wb) else None


class _Asked(dict):
    """Knows nothing, and keeps what it was asked for."""

    def get(self, key, default=None):  # noqa: ANN001, ANN201
        self[key] = True
        return default


def defects(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """pair_id, defect: one row for each defective pair."""
    model, known = _learned(pairs, rules)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Defective pairs, and those that asked for words or ends, whose texts are kept. Whatever a pair would ask for if it got
        answers it asks for without: without answers no language is another, and the end is looked at."""
        sizes, asking, n = _Zip(), replace(model, language=_Asked(), ends=_Asked()), TaskContext.get().partitionId() << 33
        for b in batches:
            kept, out = [], []
            for i, x in enumerate(b[["mode", "input", "output"]].itertuples(index=False, name=None)):
                found = defect(asking, sizes, *x)
                if asking.language or asking.ends:
                    kept.append(i)
                    out.append((n + i, None, *x, [*(_WORD + w for w in asking.language), *(_END + " ".join(c) for c in asking.ends)]))
                    asking.language.clear()
                    asking.ends.clear()
                elif found:
                    kept.append(i)
                    out.append((n + i, found, None, None, None, None))
            n += len(b)
            if out:
                some = pd.DataFrame(out, columns=["row", "defect", "mode", "input", "output", "asked"])
                some.insert(0, "pair_id", b["pair_id"].iloc[kept].reset_index(drop=True))
                yield some

    def answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = _Zip()
        for b in batches:
            found = [defect(_knowing(model, dict(langs), dict(odds)), sizes, *x) for *x, langs, odds in b[["mode", "input", "output", "langs", "odds"]].itertuples(index=False, name=None)]
            out = pd.DataFrame({"pair_id": b["pair_id"], "defect": found})
            yield out[out["defect"].notna()]

    texts = spread(pairs.select(F.col("pair_id").cast("long").alias("pair_id"), "mode", "input", "output"))
    first = materialize(texts.mapInPandas(judged, "pair_id bigint, row bigint, defect string, mode string, input string, output string, asked array<string>"), "judged")
    asked = first.filter("asked is not null")
    # both joins by a shuffle: stored texts are far larger than their files, from which the engine would guess that they can be broadcast
    answers = asked.select("row", F.explode("asked").alias("key")).hint("merge").join(known, "key").groupBy("row").agg(
        *[F.map_from_entries(F.collect_list(F.when(F.col(x).isNotNull(), F.struct("key", x)))).alias(y) for x, y in (("lang", "langs"), ("odds", "odds"))]
    )
    again = asked.select("row", "pair_id", "mode", "input", "output").hint("merge").join(answers, "row", "left")
    again = again.withColumns({x: F.coalesce(x, F.expr(f"cast(map() as map<string, {kind}>)")) for x, kind in (("langs", "string"), ("odds", "double"))})
    return first.filter("asked is null").select("pair_id", "defect").unionByName(again.mapInPandas(answered, "pair_id bigint, defect string"))
