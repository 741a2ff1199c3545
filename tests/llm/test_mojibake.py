import pytest

from quernstone.llm import mojibake as mb

NAMES = ["Crème fraîche, à la ferme", "Jalapeño peppers, at farm", "Weißwein, für Großhandel", "MAÇÃ FRESCA, na origem", "Steel sheet, at 20 °C", "Łomnica Dolna, ‘premium’ grade", "Engrais azoté, importé d’outre-mer", "Copper wire, at plant"]


def garbled(text, *codecs):
    for c in codecs:
        table = mb._table(c)
        text = "".join(table.get(b, chr(b)) for b in text.encode("utf-8"))
    return text


@pytest.fixture(scope="module")
def coder():
    many = [f"{n}, type {i}" for i in range(40) for n in NAMES]
    return mb.Coder(mb.train(many), mb.alphabet(many))


@pytest.mark.parametrize("codec", list(mb.CODEC_BITS))
@pytest.mark.parametrize("name", [n for n in NAMES if not n.isascii()])
def test_round_trip(coder, name, codec):
    assert mb.restore(garbled(name, codec), coder)[0] == name


@pytest.mark.parametrize("name", [n for n in NAMES if not n.isascii()])
def test_round_trip_of_two_and_three_garblings(coder, name):
    assert mb.restore(garbled(name, "cp1252", "cp1252"), coder)[0] == name
    assert mb.restore(garbled(name, "cp1252", "cp1252", "cp1252"), coder)[0] == name


def test_partly_garbled_and_spaced(coder):
    assert mb.restore(f"{garbled('Crème fraîche', 'cp1252')}, à la ferme", coder)[0] == "Crème fraîche, à la ferme"
    assert mb.restore(garbled("Crème fraîche, à la ferme", "cp1252").replace("\xa0", " "), coder)[0] == "Crème fraîche, à la ferme"


@pytest.mark.parametrize("text", NAMES + ["", "plain", "Really?"])
def test_clean_texts_stay(coder, text):
    assert mb.restore(text, coder)[0] is None


def test_replacement_characters_are_lost(coder):
    assert mb.restore("Cr\ufffdme", coder)[0] == ""


@pytest.mark.parametrize("text, want", [("Ïðèâåò ìèð", "Привет мир"), ("Óëüÿíîâñê, ïøåíèöà", "Ульяновск, пшеница"), ("CrÃ¨me? at farm", "Crème? at farm")])
def test_other_single_byte_encodings_and_marks(coder, text, want):
    assert mb.restore(text, coder)[0] == want


@pytest.mark.parametrize("text", ["Łódź, őrölt, űr", "Ångström, smörgås", "Çeşme, İzmir, ağaç", "Привет мир", "Γεια σας"])
def test_letters_no_clean_text_has_stay(coder, text):
    assert mb.restore(text, coder)[0] is None


def test_chains_are_followed_to_their_end(coder):
    assert mb.restore(garbled("Crème fraîche, à la ferme", *["cp1252"] * 6), coder)[0] == "Crème fraîche, à la ferme"


LOST = ["Cr?me fraîche, à la ferme", "at 20 ?C", "Wei?wein, für Großhandel", "MA?? FRESCA, na origem", "Engrais azot?, à la ferme", "Steel sheet, at 20 ?C"]
KEPT = ["Which grade? At farm", "Is it organic? yes", "Beta? carotene", "pH 7?", "Really?", "Copper wire? at plant", "Jalapeño peppers?"]


def test_question_marks_are_told_by_the_words_of_clean_texts(spark):
    rows = [("a", i, n) for i, n in enumerate(NAMES * 20)] + [("l", i, t) for i, t in enumerate(LOST)] + [("k", i, t) for i, t in enumerate(KEPT)] + [("r", 0, garbled("Crème fraîche", "cp1252") + "? à la ferme")]
    got = {(r.tab, r.rec_id): r.restored for r in mb.restored(spark.createDataFrame(rows, "tab string, rec_id bigint, text string")).collect()}
    assert got == {("l", i): "" for i in range(len(LOST))} | {("r", 0): "Crème fraîche? à la ferme"}


def test_frame(spark):
    rows = [("a", i, n) for i, n in enumerate(NAMES * 20)] + [("b", 1, garbled(NAMES[0], "cp1252")), ("b", 2, garbled(NAMES[0], "cp1252")), ("b", 3, None), ("b", 4, ""), ("b", 5, "W\ufffdrme"), ("b", 6, garbled("Crème, " * 20_000, "cp437"))]
    df = spark.createDataFrame(rows, "tab string, rec_id bigint, text string").selectExpr("*", "'x' AS restored")
    got = {(r.tab, r.rec_id): r.restored for r in mb.restored(df).collect()}
    assert got == {("b", 1): NAMES[0], ("b", 2): NAMES[0], ("b", 5): "", ("b", 6): "Crème, " * 20_000}
    assert mb.restored(df.limit(0)).count() == 0


def test_letters_are_counted_over_all_clean_texts(spark, monkeypatch):
    names = [f"{n}, type {i}" for i in range(40) for n in NAMES]
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate(names + [garbled(NAMES[0], "cp437"), "W?rme"])], "tab string, rec_id bigint, text string")
    used, rarity = [], mb.rarity
    monkeypatch.setattr(mb, "rarity", lambda seen: used.append(rarity(seen)) or used[-1])
    mb.restored(df, train_rows=5)
    assert mb.alphabet(names) in used  # not of the five texts that the dictionaries are trained on


def test_dictionaries_are_trained_on_all_clean_texts(spark):
    names = [f"sorted apple number {i} from the farm at {'north' if i % 2 else 'south'}" for i in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "text string")
    assert mb.trained(df, 1000) == mb.train(sorted(names))  # one group: as if trained at once
    for rows, groups in ((1000, 1), (50, 8)):
        got = mb.trained(df, rows)
        assert sorted(got) == ["all", "en"]
        assert all(b"from the farm at" in d for d in got.values()), groups
    # a word of few texts, all in the rest that a sample of 50 leaves out, is learned too
    rare = [f"quillwort {i} of the marsh" for i in range(60)]
    every = spark.createDataFrame([(n,) for n in names + rare], "text string")
    assert b"quillwort" in mb.trained(every, 50)["all"]
    assert mb.trained(df.limit(0), 50) == {} and mb.trained(df.limit(10), 5) == {}
