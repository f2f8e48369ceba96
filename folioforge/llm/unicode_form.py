"""One consistent form for text that looks the same but is spelled with different characters (problem 2).

Method: quick-check properties isolate unstable segments. The properties of every code point are derived once from the
Unicode data of the runtime: whether NFC may hold it (NFC_QC yes, no or maybe), its combining class, and the tag of its
compatibility mapping. A character that has quick-check yes and class 0 is a boundary; an unstable segment is what stands
between two boundaries and is not yes, together with the boundary before it. Only such segments are normalised, and the canonical
segments are spliced into the unchanged text, which gives what the normalisation of all of it would give. Before that, forms
that differ in width or design only are folded, spaces become plain, and invisible characters go; words with letters of two
scripts are brought to one by the published table of look-alikes that comes with the runtime (ICU), for all scripts.

The result is stable under NFC. Kept as they are: typographic quotes and dashes, words wholly in another script, Greek symbols
in notation, marks without a composed letter, super- and subscripts, fractions, the micro sign, joiners where the script or
a symbol needs them, tabs and line breaks.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.mojibake import Repairer

# Letters of other scripts that look like Latin ones.
CYRILLIC_AS_LATIN = dict(zip("аеорсухіѕјһԁԛԝвАВЕКМНОРСТХІЅЈԌԚԜҮӀ", "aeopcyxisjhdqwbABEKMHOPCTXISJGQWYI", strict=True)) | {"у": "y", "ү": "y", "г": "r", "к": "k", "ԍ": "g", "ӏ": "l", "У": "Y", "З": "3", "ӧ": "ö", "ї": "ï", "ѐ": "è", "ӓ": "ä", "Ԍ": "G"}
GREEK_AS_LATIN = dict(zip("οΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oABEZHIKMNOPTYX", strict=True))
GREEK_SMALL_AS_LATIN = dict(zip("ναικρτυχγη", "vaikptuxyn", strict=True))
# Tags of compatibility mappings that differ in width or design only; of the others only ligatures of letters fold.
_FOLDED_TAGS = frozenset(("<wide>", "<narrow>", "<font>", "<small>", "<isolated>", "<initial>", "<medial>", "<final>"))
# Invisible characters that are no format controls, and format controls that are seen.
_FILLERS = frozenset(map(chr, (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0)))
_SEEN = frozenset(map(chr, (*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD)))
_JOINERS = "\u200c\u200d"
# Scripts in which joiners choose the form of letters; scripts that stand beside Latin letters within a word.
_JOINING = frozenset("ARABIC SYRIAC MONGOLIAN NKO DEVANAGARI BENGALI GURMUKHI GUJARATI ORIYA TAMIL TELUGU KANNADA MALAYALAM SINHALA MYANMAR KHMER TIBETAN".split())
_BESIDE_LATIN = frozenset("CJK HIRAGANA KATAKANA HANGUL BOPOMOFO YI LATIN MODIFIER FEMININE MASCULINE MATHEMATICAL FULLWIDTH HALFWIDTH ROMAN DOUBLE-STRUCK SCRIPT BLACK-LETTER SMALL PLANCK KELVIN ANGSTROM OHM INFORMATION IDEOGRAPHIC SEGMENTED EXTENDED MICRO EULER TURNED".split())

CHANGES = ("width", "combining", "invisible", "space", "script", "form")


def _ranges(points: list[int], gap: int = 0, exact: tuple[tuple[int, int], ...] = ()) -> list[tuple[int, int]]:
    """Sorted code points as ranges; those at most ``gap`` apart are one, unless what lies between touches ``exact``."""
    out: list[list[int]] = []
    for c in sorted(points):
        if out and (c == out[-1][1] + 1 or (c - out[-1][1] <= gap and not any(out[-1][1] < hi and lo < c for lo, hi in exact))):
            out[-1][1] = c
        else:
            out.append([c, c])
    return [(a, b) for a, b in out]


def _python_class(ranges: list[tuple[int, int]]) -> str:
    return "".join(re.escape(chr(a)) + (f"-{re.escape(chr(b))}" if b > a else "") for a, b in ranges)


def _java_class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in ranges)


@lru_cache(maxsize=65536)
def script(c: str) -> str:
    """The script of a letter: the first word of its name."""
    return unicodedata.name(c, "?").split()[0].split("-")[0] if c > "\x7f" else "LATIN"


@lru_cache(maxsize=1)
def _properties() -> tuple[list[int], dict[int, str], list[int], list[int]]:
    """(code points that are no NFC boundary, folded characters, spaces, invisible characters) of all assigned code points."""
    unstable, fold, spaces, invisible = set(), {}, [], []
    unstable.update(range(0x1161, 0x1176), range(0x11A8, 0x11C3))  # vowels and finals of syllables: quick-check maybe
    for o in range(0x80, 0x110000):
        c = chr(o)
        category = unicodedata.category(c)
        if category in ("Cn", "Cs", "Co"):
            continue
        if category == "Zs":
            spaces.append(o)
            continue
        if (category == "Cf" and c not in _SEEN) or c in _FILLERS or 0xE0000 <= o <= 0xE007F:
            invisible.append(o)
            continue
        nfc = unicodedata.normalize("NFC", c)
        if nfc != c or unicodedata.combining(c):
            unstable.add(o)
        mapping = unicodedata.decomposition(c).split()
        if not mapping:
            continue
        if mapping[0] in _FOLDED_TAGS:
            fold[o] = unicodedata.normalize("NFKC", c)
        elif mapping[0] == "<compat>" and len(mapping) > 2 and category in ("Ll", "Lu", "Lo") and o >= 0xFB00:
            fold[o] = unicodedata.normalize("NFKC", c)
        elif mapping[0][0] != "<" and nfc == c and len(mapping) == 2:
            unstable.add(int(mapping[1], 16))  # composes with what stands before it: quick-check maybe
    return sorted(unstable), fold, spaces, invisible


@lru_cache(maxsize=2)
def _patterns(most: int) -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern]:
    """Runs of what is no boundary, of folded characters, spaces, and runs of invisible characters, up to code point ``most``:
    texts without characters beyond the first plane are looked through much faster without those."""
    unstable, fold, spaces, invisible = _properties()
    of = lambda points: _python_class(_ranges([p for p in points if p <= most]))
    return re.compile(f"[{of(unstable)}]+"), re.compile(f"[{of(fold)}]+"), re.compile(f"[{of(spaces)}]"), re.compile(f"[{of(invisible)}]+")


def splice(text: str, run: re.Pattern) -> tuple[str, set[str]]:
    """``text`` with every unstable segment, a run of what is no boundary with the boundary before it, normalised; and the kinds
    of what was changed."""
    out, last, kinds = [], 0, set()
    for m in run.finditer(text):
        start = max(last, m.start() - 1)
        segment = text[start : m.end()]
        form = unicodedata.normalize("NFC", segment)
        if form != segment:
            kinds.add("combining" if len(form) < len(segment) else "form")
            out += (text[last:start], form)
            last = m.end()
    return ("".join((*out, text[last:])), kinds) if out else (text, kinds)


@lru_cache(maxsize=1)
def _foreign() -> list[tuple[int, int]]:
    """Letters of scripts that do not stand beside Latin letters within a word."""
    letters = [o for o in range(0x370, 0x20000) if unicodedata.category(chr(o))[0] == "L" and script(chr(o)) not in _BESIDE_LATIN]
    return _ranges(letters)


_MARKS = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff"
_LATIN = "A-Za-zÀ-ɏḀ-ỿ"


@lru_cache(maxsize=2)
def _mixed(most: int) -> tuple[re.Pattern, re.Pattern]:
    """Where letters of two scripts meet, and a word in which they do."""
    foreign, inside = _python_class([(a, min(b, most)) for a, b in _foreign() if a <= most]), f"(?:[^\\W\\d_]|[{_MARKS}])"
    meet = f"(?:[{_LATIN}][{_MARKS}]*[{foreign}]|[{foreign}][{_MARKS}]*[{_LATIN}])"
    return re.compile(meet), re.compile(f"{inside}*{meet}{inside}*")


def unstable_jvm() -> str:
    """What the JVM looks for before any text goes to Python: a superset of all that ``canonical`` changes. Neighbouring ranges
    are joined where no common letters lie between, which keeps the class small."""
    unstable, fold, spaces, invisible = _properties()
    exact = ((0x80, 0x24F), (0x370, 0x52F), (0x2010, 0x2027), (0x2030, 0x2050), (0x3041, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))
    single = _java_class(_ranges([*unstable, *fold, *spaces, *invisible], 200, exact))
    foreign = _java_class(_ranges([o for a, b in _foreign() for o in range(a, b + 1)], 4000, ((0x3000, 0xA4CF), (0xAC00, 0xD7A3))))
    return rf"[{single}]|\p{{IsLatin}}[{foreign}]|[{foreign}]\p{{IsLatin}}|{_RARE_DOUBLE.pattern}"


def look_alikes(spark: SparkSession) -> dict[str, str]:
    """Letters of all scripts that look like a Latin one: those with the same skeleton in the table of look-alikes that the
    JVM's ICU brings along, and the fixed values above, which add what looks alike in most fonts only."""
    letters = [chr(o) for a, b in _foreign() for o in range(a, b + 1)]
    latin = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    skeleton = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton
    of = dict(zip([*latin, *letters], skeleton("\n".join([*latin, *letters])).split("\n"), strict=True))
    by: dict[str, list[str]] = {}
    for c in latin:
        by.setdefault(of[c], []).append(c)
    out = {}
    for c in letters:
        if like := by.get(of[c]):
            out[c] = next((x for x in like if x.isupper() == c.isupper()), like[0])
    return out | FIXED


FIXED = CYRILLIC_AS_LATIN | GREEK_AS_LATIN
_TO_CYRILLIC = {v: k for k, v in reversed(list(CYRILLIC_AS_LATIN.items())) if k not in "гкв" and v.isalpha() and v.isascii()}


def _one_script(word: str, doubles: dict[str, str]) -> str:
    """A word of letters from two scripts: those that look like letters of its main script become such."""
    scripts = [script(c) if c.isalpha() else "" for c in word]
    latin, cyrillic, greek = (scripts.count(x) for x in ("LATIN", "CYRILLIC", "GREEK"))
    others = set(scripts) - {"LATIN", "CYRILLIC", "GREEK", ""}
    for name in others:
        own = [c for c, s in zip(word, scripts, strict=True) if s == name]
        if latin and all(c in doubles for c in own):
            word = "".join(doubles[c] if s == name else c for c, s in zip(word, scripts, strict=True))
    if greek:
        small = GREEK_SMALL_AS_LATIN if latin >= 2 and len(word) >= 3 and word.islower() or latin >= 3 else {}
        word = "".join(GREEK_AS_LATIN.get(c, small.get(c, c)) for c in word)
    if cyrillic:
        own = [c for c in word if script(c) == "CYRILLIC"]
        if all(c in CYRILLIC_AS_LATIN or c in doubles for c in own) and (latin or greek):
            # Every Cyrillic letter has a Latin double: a Latin word, unless Latin doubles are what is foreign in it.
            rest = [c for c in word if c.isalpha() and script(c) == "LATIN"]
            if len(rest) >= len(own) or not all(c in _TO_CYRILLIC for c in rest):
                return "".join(CYRILLIC_AS_LATIN.get(c) or (doubles.get(c, c) if script(c) == "CYRILLIC" else c) for c in word)
        return "".join(_TO_CYRILLIC.get(c, c) for c in word)
    return word


# Cyrillic letters that look Latin and that no large Cyrillic orthography uses beside the others: a word made of doubles with
# one of them, in a Latin text, is a Latin word all of whose letters were replaced.
_RARE_DOUBLE = re.compile("[ѕһԁԛԝԍӏ]")
_DOUBLES = re.compile(f"\\b[{''.join(CYRILLIC_AS_LATIN)}]+\\b")


def _needed(m: re.Match) -> bool:
    """Whether joiners are needed where they stand: in scripts whose letters they shape, and between symbols."""
    before = m.string[m.start() - 1 : m.start()]
    if not before or any(c not in _JOINERS for c in m[0]):
        return False
    return script(before) in _JOINING or unicodedata.category(before) in ("So", "Sk") or 0xFE00 <= ord(before) <= 0xFE0F


def changes(text: str, doubles: dict[str, str] = FIXED) -> tuple[str, set[str]]:
    """(the canonical form, kinds of what was changed, out of CHANGES); nothing was changed exactly if nothing is unstable."""
    if text.isascii():
        return text, set()
    most = 0x10FFFF if max(text) > "\uffff" else 0xFFFF
    run, folded, space, invisible = _patterns(most)
    meet, mixed = _mixed(most)
    kinds: set[str] = set()

    def fold(m: re.Match) -> str:
        table = _properties()[1]
        kinds.update("width" if unicodedata.decomposition(c).startswith("<wide>") else "form" for c in m[0])
        return "".join(table[ord(c)] for c in m[0])

    def hide(m: re.Match) -> str:
        if _needed(m):
            return m[0]
        kinds.add("invisible")
        return ""

    def one_script(m: re.Match) -> str:
        out = _one_script(m[0], doubles)
        if out != m[0]:
            kinds.add("script")
        return out

    def all_doubles(m: re.Match) -> str:
        if not _RARE_DOUBLE.search(m[0]):
            return m[0]
        kinds.add("script")
        return "".join(CYRILLIC_AS_LATIN[c] for c in m[0])

    out, n = space.subn(" ", text)
    if n:
        kinds.add("space")
    out, composed = splice(folded.sub(fold, invisible.sub(hide, out)), run)
    kinds |= composed
    if meet.search(out):
        out = mixed.sub(one_script, out)
    if _RARE_DOUBLE.search(out) and len(re.findall("[A-Za-z]", out)) > len(re.findall("[Ѐ-џ]", out)):
        out = _DOUBLES.sub(all_doubles, out)
    # A letter that was replaced may compose with the marks behind it.
    return (splice(out, run)[0], kinds) if "script" in kinds else (out, kinds)


def canonical(text: str, doubles: dict[str, str] = FIXED) -> str:
    """The canonical form; equal to ``text`` exactly if nothing in it is unstable."""
    return changes(text, doubles)[0]


def unstable(records: DataFrame) -> DataFrame:
    """The rows of (record_kind, record_id, text) that may have unstable segments, found in the JVM."""
    return records.filter((F.octet_length("text") > F.length("text")) & F.col("text").rlike(unstable_jvm()))


def canonical_texts(records: DataFrame, pairs: dict[str, float]) -> DataFrame:
    """(record_kind, record_id, canonical, changes) of the records that are not in canonical form.

    ``changes`` are the kinds of what was changed, sorted. Null and empty texts are canonical. Records with wrongly decoded
    characters are left to the repair of problem 5 and not returned. Repeated rows each give their row.
    """
    spark = records.sparkSession
    shared = spark.sparkContext.broadcast((pairs, look_alikes(spark)))  # as many entries as alphabets have

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, doubles = Repairer(shared.value[0]), shared.value[1]
        for batch in batches:
            keep, texts, kinds = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                form, why = changes(text, doubles)
                if form != text and not repairer.repair(text)[1]:
                    keep.append(i)
                    texts.append(form)
                    kinds.append(sorted(why))
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep, pa.int32())) for c in batch.columns[:2]), pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string()))], names=["record_kind", "record_id", "canonical", "changes"])

    return unstable(records.select("record_kind", "record_id", "text")).mapInArrow(run, "record_kind string, record_id long, canonical string, changes array<string>")
