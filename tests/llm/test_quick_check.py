"""The canonical form against the Unicode data: normal form, splicing, and the filter of the JVM."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import unicode_form as U

POINTS = [chr(o) for o in range(0x80, 0x110000) if unicodedata.category(chr(o)) not in ("Cn", "Cs", "Co")]
PARTS = st.sampled_from([*"aeoАеKx ", "́", "̣", "̧", "ͅ", "ᄀ", "ᅡ", "ᆨ", "가", "Ω", "Å", "K", "क़", "ά", "豈", "̈́", "゙", "か", "େ", "ା", "ཱ", "\U0001d15e", "é", "ế"])


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_segments_spliced_equal_the_whole(text):
    """Normalising unstable segments only gives the normal form of the whole text."""
    assert U.splice(text, U._patterns(0x10FFFF)[0])[0] == unicodedata.normalize("NFC", text)


def test_every_code_point_becomes_stable():
    for c in POINTS:
        for text in (c, "a" + c, c + "a", "é" + c):
            form = U.canonical(text)
            assert unicodedata.is_normalized("NFC", form) and U.canonical(form) == form, (hex(ord(c)), text)


@pytest.mark.parametrize(
    ("text", "form", "kinds"),
    [
        ("\u212b \u2126 \u212a", "\xc5 \u03a9 K", "form"),
        ("\u1100\u1161\u11a8", "\uac01", "combining"),
        ("\uf900", "\u8c48", "form"),
        ("\u1f71", "\u03ac", "form"),
        ("\u0958", "\u0915\u093c", "form"),
        ("o\ufb03ce", "office", "form"),
        ("\U0001d400\U0001d41b", "Ab", "form"),
        ("\uff76\uff9e", "\u30ac", "form combining"),
        ("q\u0307\u0323", "q\u0323\u0307", "form"),
        ("\u0646\u200c\u0647", "\u0646\u200c\u0647", ""),
        ("\U0001f469\u200d\U0001f4bb", "\U0001f469\u200d\U0001f4bb", ""),
        ("a\u200db", "ab", "invisible"),
        ("5 \xb5m\xb2 \xbd \u2122 \u2163 \u2460 \u2103", "5 \xb5m\xb2 \xbd \u2122 \u2163 \u2460 \u2103", ""),
    ],
)
def test_forms(text, form, kinds):
    assert U.changes(text) == (form, set(kinds.split()))


def test_look_alikes_of_all_scripts(spark):
    doubles = U.look_alikes(spark)
    assert {U.script(c) for c in doubles} >= {"GREEK", "CYRILLIC", "ARMENIAN", "CHEROKEE", "COPTIC", "LISU"} and all(v.isascii() for k, v in doubles.items() if k not in U.FIXED)
    assert U.canonical("p\u2c9ftato", doubles) == "potato" and U.canonical("t\u0585\u0585l", doubles) == "tool"
    assert U.canonical("\u056b\u0576\u0579 why", doubles) == "\u056b\u0576\u0579 why"


def test_the_filter_is_a_superset(spark):
    """Whatever code point ``canonical`` changes, alone or beside a letter, passes the filter of the JVM."""
    doubles = U.look_alikes(spark)
    rows = [(i, t) for i, t in enumerate(t for c in POINTS if not ("一" <= c <= "鿿" or "가" <= c <= "힣") for t in (c, "a" + c, c + "b", "an" + c + "ther"))]
    changed = {i for i, t in rows if U.canonical(t, doubles) != t}
    df = spark.createDataFrame([r for r in rows if r[0] in changed], "record_id long, text string")
    passed = {r["record_id"] for r in U.unstable(df).collect()}
    assert sorted(changed - passed)[:20] == [] and len(changed) > 4000
