"""Wrong decoding and canonical forms: round trips and goldens."""

import math

import pytest

from folioforge.llm import mojibake as J
from folioforge.llm import unicode_form as U

CLEAN = ["café crème façade", "Größe der Körnung – „über“ 5 °C", "naïve résumé…", "it’s “too humid”", "à basse température: 3.2 µm", "Señal acústica", "São Tarvo não", "≈ ≥ − ½ ±"]


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "cp437", "mac_roman", "cp1250"])
@pytest.mark.parametrize("text", CLEAN)
def test_round_trip(text, encoding):
    raw = text.encode("utf-8")
    garbled = "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in raw)
    fixed, found = J.Repairer({}).repair(garbled)
    assert found and (fixed == text or encoding == "cp1250")


def test_twice_and_partly():
    once = "crème façade".encode().decode("cp1252")
    assert J.Repairer({}).repair(once.encode().decode("cp1252")) == ("crème façade", True)
    assert J.Repairer({}).repair("legit é and faÃ§ade") == ("legit é and façade", True)
    assert J.Repairer({}).repair("&Atilde;&copy;t&Atilde;&copy;")[1]
    assert J.Repairer({}).repair("lost �")[1]


@pytest.mark.parametrize("text", [*CLEAN, "A ESTAÇÃO SÃO TARVO NÃO", "Šárkov and Łomniak", "Þórðarnes", "«été»", "β ≈ 3 λ₀", "The word “да” and ш", "СССР» и РЁ", "x̄ q̇", "R&D &lt;1 nm &amp; &nbsp;", "2.1 Å", "", "plain", "Еіnlеіtung", "\u00a0рrеѕѕurе\u00a0x"])
def test_sound_text_stays(text):
    assert J.Repairer({}).repair(text) == (text, False)


def test_swapped_alphabets(spark):
    text = "Пористый слой замедляет перенос тепла при низкой температуре. Датчик давления снижает скорость течения."
    df = spark.createDataFrame([("block", i, text) for i in range(40)] + [("block", 99, None), ("block", 98, "")], "record_kind string, record_id long, text string")
    pairs = J.pair_counts(df)
    assert pairs and all(v <= 0 and math.isfinite(v) for v in pairs.values())
    r = J.Repairer(pairs)
    for right, wrong in (("cp1251", "cp1252"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r")):
        garbled = text.encode(right).decode(wrong)
        fixed, found = r.repair(garbled)
        assert found and fixed == text
    assert r.repair(text) == (text, False)
    assert r.repair(text.upper()) == (text.upper(), False)
    found = J.repair_texts(df.unionByName(spark.createDataFrame([("paper", 1, text.encode("koi8_r").decode("cp1251"))] * 2, df.schema)), pairs).collect()
    assert [(x["record_kind"], x["record_id"], x["repaired"]) for x in found] == [("paper", 1, text)] * 2
    assert J.repair_texts(df.limit(0), {}).count() == 0 and J.pair_counts(df.limit(0)) == J.log_probabilities(J.general_pairs())


@pytest.mark.parametrize(
    ("text", "form"),
    [("Ｃｏｎｃ 12", "Conc 12"), ("cafe\u0301", "café"), ("so\u200b-ca\u00adlled", "so-called"), ("a\u00a0b\u2003c\u3000d\u202fe", "a b c d e"), ("m\u0435asured", "measured"), ("тaмпература", "тампература"), ("b\u03bfx", "box"), ("tһеrmаl", "thermal"), ("the flow іѕ ѕlow here", "the flow is slow here")],
)
def test_canonical(text, form):
    assert U.canonical(text) == form
    assert U.canonical(form) == form


@pytest.mark.parametrize("text", ["“quotes” – dashes…", "слой и да", "Δt = 5, γ-ray, β ≈ λ₀, αv", "x̄ q̇", "tab\tand\nline", "µm °C ½", "", "²"])
def test_stable(text):
    assert U.canonical(text) == text


def test_unstable_in_the_jvm(spark):
    texts = ["Ｃ", "e\u0301", "a\u200bb", "a\u00a0b", "m\u0435a", "plain", "café", None, "", "слой", "a\u2060b", "a\U000e0001b"]
    df = spark.createDataFrame([("block", i, t, "x") for i, t in enumerate(texts)], "record_kind string, record_id long, text string, canonical string")
    got = {r["record_id"] for r in U.canonical_texts(df, {}).collect()}
    assert got == {0, 1, 2, 3, 4, 10, 11}
    assert {i for i, t in enumerate(texts) if t and U.canonical(t) != t} == got
    garbled = spark.createDataFrame([("block", 1, "Ã\u00a0 basse")], "record_kind string, record_id long, text string")
    assert U.canonical_texts(garbled, {}).count() == 0


RUSSIAN = "Пористый слой замедляет перенос тепла при низкой температуре"
GREEK = "Οι άνθρωποι έχουν δικαίωμα στην ελευθερία και στην ασφάλεια"
HEBREW = "כל בני האדם חייבים לנהוג איש ברעהו ברוח של כבוד"
ARABIC = "يولد الناس أحرارا ولهم جميعا حقوق متساوية في الكرامة"


@pytest.mark.parametrize(("text", "right", "wrong"), [(RUSSIAN, "cp1251", "cp1252"), (RUSSIAN, "koi8_r", "cp1251"), (GREEK, "cp1253", "cp1252"), (HEBREW, "cp1255", "cp1252"), (ARABIC, "cp1256", "cp1252")])
def test_swapped_in_small_tables(text, right, wrong):
    """The general sentences are enough where the table tells nothing."""
    pairs = J.log_probabilities(J.general_pairs())
    garbled = text.encode(right).decode(wrong, "replace")
    fixed, found = J.Repairer(pairs).repair(garbled)
    if "\ufffd" not in garbled:
        assert found and sum(a == b for a, b in zip(fixed, text, strict=False)) > 0.8 * len(text)
    assert J.Repairer(pairs).repair(text) == (text, False)


@pytest.mark.parametrize("text", ["数据的质量决定模型的质量", "日本語の文章を読みます", "데이터의 품질이 중요합니다", "ไทยเป็นภาษา", "हिन्दी भाषा", "עברית", "العربية", "ქართული ენა"])
@pytest.mark.parametrize("wrong", ["latin-1", "cp1252", "gb18030", "cp1253"])
def test_other_scripts_round_trip(text, wrong):
    raw = text.encode("utf-8")
    try:
        garbled = raw.decode(wrong)
    except UnicodeError:
        garbled = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in raw) if wrong == "cp1252" else None
    if garbled:
        assert J.Repairer({}).repair(garbled) == (text, True)
    assert J.Repairer({}).repair(text) == (text, False)


@pytest.mark.parametrize(("text", "right"), [("数据的质量决定模型的质量", "gb18030"), ("資料的品質決定模型", "big5hkscs")])
def test_east_asian_read_as_latin(text, right):
    """Korean and Japanese text is found as well, but the frequent bytes of Chinese are too near to tell which it was."""
    raw = text.encode(right)
    garbled = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in raw)
    fixed, found = J.Repairer({}).repair(garbled)
    assert (fixed, found) == (text, True)


@pytest.mark.parametrize("text", ["ÄÖÜäöüß", "ÉÈÀÇÙ", "¿¡«»ÀÉ", "ÅÄÖåäö ÆØÅæøå", "éèêëàâçùûüïî"])
def test_letters_in_a_row_are_sound(text):
    assert J.Repairer(J.log_probabilities(J.general_pairs())).repair(text) == (text, False)


def test_long_words():
    long = "façade" * 700
    assert J.Repairer({}).repair(long.encode().decode("cp1252")) == (long, True)
