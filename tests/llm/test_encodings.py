import pytest

from textmill.llm import encodings as E

DOC = "doc_id bigint, text string, key string, variant string, n int"
WAYS = [*E.ALWAYS, ("utf_8", "cp437", 1), ("utf_8", "cp1253", 1), ("utf_8", "mac_roman", 1), ("cp1252", "mac_roman", 1), ("cp1252", "cp437", 1), ("cp1252", "cp850", 1), ("cp1253", "cp1252", 1)]
CLEAN = ["Mësuesja për shkallën çdo ditë…", "Κάθε μέρα στις 8 «το παιδί» ΠΕΡΣΙ…", "¿Qué niño pagó 5 €?", "NÃO. Âme! Île? Ångström Œuvre Škoda-style Füße À LA CARTE naïve café", "Привет", "½ kg · 18 °C \U0001f9d1‍\U0001f373 ❤️ ♪", "plain", "ë ëë ç"]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_stays(text):
    assert E.Undo(WAYS).text(text) == (False, text, True)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("text", ["Mësuesja për shkallën çdo ditë", "Κάθε μέρα το παιδί έφυγε νωρίς", "El niño pagó después"])
def test_round_trip(way, text):
    bad = E.garble(text, way)
    if bad is None or bad == text:
        pytest.skip("this way can't misread this text")
    assert E.undo(bad, way) == text
    found, plain, _ = E.Undo(WAYS).text("ok " + bad)
    assert found
    if way[0] == "utf_8":
        assert plain == "ok " + text


def test_partial_and_lost():
    u = E.Undo(WAYS)
    assert u.text("clean start pÃ«r end")[1:] == ("clean start për end", True)
    found, plain, whole = u.text("Retebob� went")
    assert found and not whole and plain == "Retebob� went"
    found, plain, whole = u.text("τελος ÏŒÏ?Î¿Ï†Î¿ εδώ")
    assert found and "ό" in plain and not whole
    assert u.text("x\x92s")[0]


def test_page_damage_that_looks_ordinary():
    u = E.Undo(WAYS)
    greek = "Η μητέρα μου θέλει να φύγει αν η βροχή περάσει. Ο καιρός όλη μέρα άλλα δείχνει, ένα παιδί. Το φως"
    bad = E.garble(greek, ("cp1253", "cp1252", 1))
    assert not any(E.SUSPECT.search(t) for t in ("íá", "áí", "ç", "Ï", "üëç", "Üëëá"))
    assert u.text(bad) == (True, greek, True)
    half = "Το παιδί είναι καλά και á " + bad
    assert u.text(half) == (True, "Το παιδί είναι καλά και á " + E.garble("Η", ("cp1253", "cp1252", 1)) + greek[1:], False)
    mac = E.garble("çdo ditë", ("cp1252", "mac_roman", 1))
    assert u.text("për të " + mac + " një ditë")[1] == "për të Ádo ditë një ditë"
    assert u.text("ditÎ " + mac) == (True, "ditë çdo ditë", True)


def test_learned_from_twins(spark, rows):
    names = ["bashkë", "për", "gjatë", "shkallën", "është", "njëra", "lëviz", "mënyrë", "çdo", "këtu"]
    docs = [(k, " ".join(names), "x", "y", 1) for k in range(20)]
    docs += [(100 + k, " ".join(E.garble(n, ("utf_8", "cp437", 1)) for n in names[k : k + 3]), "x", "y", 1) for k in range(6)]
    docs += [(200, "Bos" + E.garble("ë", ("utf_8", "cp437", 1)) + "damash", "x", "y", 1), (300, None, "x", "y", 1), (301, "", "x", "y", 1), (302, "a" * 300_000, "x", "y", 1), (303, "ë " * 100_000, "x", "y", 1)]
    df = spark.createDataFrame(docs, DOC)
    ways = E.learn(df)
    assert ("utf_8", "cp437", 1) in ways
    got = {r.doc_id: (r.text, r.complete) for r in E.restored(df, ways=ways).collect()}
    assert set(got) == {100, 101, 102, 103, 104, 105, 200}
    assert got[200] == ("Bosëdamash", True) and got[100] == (" ".join(names[:3]), True)


def test_all_clean_variants_are_twins(spark):
    way = ("cp1253", "cp1252", 1)
    learned = lambda texts: E.learn(spark.createDataFrame([(k, t, "x", "y", 1) for k, t in enumerate(texts)], DOC))
    assert way not in learned(["το παιδί abc", "το παιδί xyz"])
    bad = [E.garble("παιδί", way) + " " + x for x in ("abc", "xyz")]
    assert way in learned(["παιδί abc", "παιδί xyz"] + 5 * bad)  # the garbled variant is the most frequent
    assert way in learned(["παιδί abc", "παιδί xyz"] + 5 * ["μέρα abc", "μέρα xyz"] + bad)  # another clean one is
    long = "παιδί" * 40
    assert way in learned([f"{long} {x}" for x in ("abc", "xyz")] + [f"{E.garble(long, way)} {x}" for x in ("abc", "xyz")])
    mac, words = ("cp1252", "mac_roman", 1), ["xçxçxçxçxçxë", "yçyçyçyçyçyë"]
    assert mac in learned(words + [E.garble(w, mac) for w in words])  # more open runs than are listed
    part = ["mëngrë", "përtë"]
    assert ("cp1252", "cp437", 1) in learned(part + [w[:2] + E.garble(w[2:], ("cp1252", "cp437", 1)) for w in part])


def test_empty(spark, rows):
    assert E.learn(spark.createDataFrame([], DOC)) == list(E.ALWAYS)
    assert rows(E.restored(spark.createDataFrame([], DOC))) == []


@pytest.mark.parametrize(
    "text",
    [
        "Die schöne Größe der Bäume überrascht Jürgen; Äpfel, Öl und Übung sind süß. Fußgänger grüßen höflich.",
        "À l’école, les élèves étudient où l’été naît; ça coûte très cher, Noël, cœur, forêt, île, garçon, maïs.",
        "Dzień dobry, żółć i łódź są w Gdańsku; proszę, źle, święto, śnieg, często, ćma, koń, mąż, rękę.",
        "Žluťoučký kůň úpěl ďábelské ódy; říkám, že příliš žízní, děkuji, čeština, škola, ještě, něco, účet.",
        "Őrült, árvíztűrő tükörfúrógép, köszönöm szépen, hűség.",
        "Ideeën, coördinatie, financiële, één.",
        "schöne", "Bäume", "Größe", "São", "não", "coûte", "Gdańsku;", "kůň", "köszönöm",
    ],
)
def test_other_languages_stand_even_with_all_ways_learned(text):
    assert E.Undo(list(E.FAMILY)).text(text) == (False, text, True)
