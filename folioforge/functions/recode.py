"""Words that were decoded with the wrong character encoding: the search for the text that was meant.

An operation writes a word's characters as the bytes of some encoding and reads those bytes as another one, or resolves
character references; states already seen (by hash) are not visited again. A cost of implausible characters and neighbours
guides the search, and the cheapest word reached is the repair, if it is clearly cheaper than the given one. Operations make a word
shorter, so every search ends by itself.
"""

from __future__ import annotations

import heapq
import html
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

# Encodings in which UTF-8 bytes are commonly misread.
MISREAD = ("cp1252", "cp1250", "cp1251", "cp437", "mac_roman", "cp850", "iso8859_2", "koi8_r", "cp866", "cp1253", "cp1254", "cp1255", "cp1256", "cp1257", "cp852", "iso8859_7", "mac_cyrillic")
#: East Asian encodings, and the first bytes of their frequent characters: of other text read so, few are such.
WIDE = {"gb18030": ((0xB0, 0xD7),), "cp932": ((0x82, 0x83), (0x88, 0x97)), "cp949": ((0xB0, 0xC8),), "big5hkscs": ((0xA4, 0xC6),)}
TYPOGRAPHY = frozenset("–—‘’“”„‚…°±µ×·•«»§½¼¾€£≤≥≈−→′″²³")
_USUAL = frozenset(("latin", "greek", "cyrillic"))
#: A repair must be cheaper by more than this; reading East Asian text out of Latin letters, which nearly any letters allow,
#: costs so much by itself.
MARGIN, FAR_FETCHED = 0.9, 5.0
#: Signs of measure and reckoning: a letter with a mark does not follow them without a blank.
_SIGNS = frozenset("°±×·½¼¾≤≥≈→′″²³§•")

LOST = re.compile("[�\x80-\x84\x86-\x9f]")
#: Words with a character beyond ASCII or a character reference. They are tried from their beginning only, so that a long word
#: is read once.
WORD = re.compile(
    r"(?<![^ \t\r\n])(?:[\x00-\x08\x0b\x0c\x0e-\x1f\x21-\x7f]*[^\x00-\x7f][^ \t\r\n]*|(?=[^ \t\r\n&]*&)[^ \t\r\n]*?&(?:#\d{2,7}|#[xX][0-9a-fA-F]{2,6}|[A-Za-z]{2,8});[^ \t\r\n]*)"
)


@lru_cache(maxsize=65536)
def _kind(c: str) -> tuple[str, float, bool]:
    """(script or class, cost, is a letter) of one character."""
    o = ord(c)
    if o < 0x80:
        return ("latin" if c.isalpha() else "", 0.0 if o >= 32 or c in "\t\n\r" else 6.0, c.isalpha())
    if o == 0xFFFD or 0x80 <= o <= 0x9F or 0xE000 <= o <= 0xF8FF:
        return ("bad", 8.0, False)
    if c in TYPOGRAPHY:
        return ("symbol", 1.0, False)
    category = unicodedata.category(c)
    # What texts have only by way of a wrong reading: phonetic and modifier letters and signs, the long s, rare ideographs.
    if o == 0x17F or 0x250 <= o < 0x300 or 0x3400 <= o < 0x4DC0 or o >= 0x20000:
        return ("rare", 6.0, category[0] == "L")
    if category[0] == "L" and c not in "ªº":
        if 0xC0 <= o <= 0x17F:
            return ("latin", 1.0, True)
        if 0x400 <= o <= 0x45F:
            return ("cyrillic", 0.6, True) if 0x410 <= o <= 0x44F or c in "ёЁ" else ("cyrillic", 1.6, True)
        if 0x370 <= o <= 0x3FF:
            return ("greek", 0.8, True)
        return (unicodedata.name(c, "?").split()[0].lower(), (3.0 if 0x180 <= o < 0x250 else 1.2) if o < 0x2E80 else 2.0, True)
    if category[0] == "M":
        return ("mark", 3.5, False) if o < 0x590 else (unicodedata.name(c, "?").split()[0].lower(), 1.2, True)  # vowels are marks in many alphabets
    if category == "Zs" or category == "Cf":
        return ("space", 1.0, False)
    return ("symbol", 4.0 if 0x2500 <= o <= 0x25FF else 3.0 if category in ("So", "Sk", "Sm", "Po", "Pi", "Pf", "Ps") else 2.0, False)


def cost(s: str) -> float:
    """How implausible the characters of ``s`` are."""
    total, before, letter_before, script, upper_run, lonely = 0.0, "", False, "", 0, 0.0
    for c in s:
        kind, price, letter = _kind(c)
        total += price
        if letter:
            if letter_before:
                if kind != script:
                    total += lonely
                    total += 3.0 if kind in _USUAL and script in _USUAL else 6.0
                if price and kind == "latin" and before >= "\x80":
                    total += 1.0
                if c.isupper() and not before.isupper():
                    total += 2.0
                elif c.islower() and upper_run >= 2:
                    total += 1.5
            elif before >= "\x80" and kind != "latin" and _kind(before)[0] == "symbol" and c.islower():
                total += 0.5
            elif price and before in _SIGNS and before:
                total += 0.5
            upper_run = upper_run + 1 if c.isupper() else 0
            # A single letter of a rare alphabet is no text.
            lonely = 4.0 if kind not in _USUAL and c < "\u2e80" and not (letter_before and kind == script) else 0.0
            script = kind
        else:
            total += lonely
            lonely = 0.0
            if price and letter_before and c not in "’…–—”»“" and (before >= "\x80"):
                total += 1.0
            upper_run = 0
        letter_before, before = letter, c
    return total + lonely


@lru_cache(maxsize=64)
def _bytes_of(encoding: str) -> dict[str, int]:
    """Character to byte; bytes that the encoding leaves open, or lost to C1 controls, count as themselves."""
    out = {chr(b): b for b in range(0x80, 0xA0)}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            pass
    if encoding == "cp1252":  # Latin-1 is its subset
        out |= {chr(b): b for b in range(0xA0, 0x100)}
    return out


@lru_cache(maxsize=64)
def _sequence(encoding: str) -> re.Pattern:
    """Characters that are, as bytes of ``encoding``, a UTF-8 sequence of two to four bytes."""
    of = _bytes_of(encoding)
    group = lambda low, high: "[" + "".join(re.escape(c) for c, b in of.items() if low <= b <= high) + "]"
    tail = group(0x80, 0xBF)
    return re.compile(f"{group(0xC2, 0xDF)}{tail}|{group(0xE0, 0xEF)}{tail}{tail}|{group(0xF0, 0xF4)}{tail}{tail}{tail}")


@lru_cache(maxsize=65536)
def _may_be_meant(c: str) -> bool:
    """Whether a decoded character is one that texts have: a letter or mark of any script, or a usual sign, or a control
    character of the C1 block, which the next operation may need."""
    o, category = ord(c), unicodedata.category(c)
    if category in ("Cn", "Co", "Cs") or o < 0x80:
        return False
    return o < 0x530 or category[0] in "LM" or 0x2000 <= o < 0x2150 or 0x2190 <= o < 0x2500 or 0x3000 <= o < 0x3003 or 0xFF00 <= o < 0xFFF0 or o in (0xFEFF, 0xFFFD) or 0x1F000 <= o < 0x1FB00


def reread(s: str, encoding: str) -> str:
    """``s`` with all valid UTF-8 sequences, written in ``encoding``, decoded."""
    of = _bytes_of(encoding)

    def one(m: re.Match) -> str:
        try:
            c = bytes(of[c] for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]
        return c if _may_be_meant(c) else m[0]

    return _sequence(encoding).sub(one, s)


_BEYOND = re.compile("[^\x00-\x7f]+")


def reread_wide(s: str, encoding: str) -> str:
    """``s`` with the runs of characters beyond ASCII that are, as bytes of an East Asian ``encoding``, valid UTF-8, decoded."""

    def one(m: re.Match) -> str:
        try:
            out = m[0].encode(encoding).decode("utf-8")
        except UnicodeError:
            return m[0]
        return out if all(map(_may_be_meant, out)) else m[0]

    return _BEYOND.sub(one, s)


def best_first(start: str, steps, price) -> tuple[str, float]:
    """The cheapest string reachable from ``start`` and its cost. ``steps`` gives (string, whether it counts as a result, what it
    adds to the cost) of a string and its depth, ``price`` the cost of a string."""
    best, best_cost = start, math.inf
    heap, seen, n = [(price(start), 0, start, False, 0.0, 0)], {hash(start)}, 0
    while heap:
        total, _, s, counts, paid, depth = heapq.heappop(heap)
        if counts and total < best_cost:
            best, best_cost = s, total
        for t, is_result, extra in steps(s, depth):
            if t != s and (h := hash(t)) not in seen:
                seen.add(h)
                n += 1
                heapq.heappush(heap, (price(t) + paid + extra, n, t, is_result or counts, paid + extra, depth + 1))
    return best, best_cost


def _word_steps(s: str, depth: int) -> Iterator[tuple[str, bool, float]]:
    for e in MISREAD:
        yield reread(s, e), True, 0.0
    for e in WIDE:
        yield reread_wide(s, e), True, 0.0
    if "&" in s:
        yield html.unescape(s), False, 0.0


def _wide_steps(s: str, depth: int) -> Iterator[tuple[str, bool, float]]:
    if not depth and sum("\x7f" < c < "\u0180" or "\u2000" < c < "\u2200" for c in s) >= 6:
        for e in WIDE:
            yield read_wide(s, e), True, FAR_FETCHED


def repair_word(word: str) -> str:
    """The cheapest string reachable from ``word`` if it is clearly cheaper, else ``word``."""
    start = cost(html.unescape(word) if "&" in word else word)  # references may well be meant: only what decoding makes better counts
    best, best_cost = best_first(word, _word_steps, cost)
    if best_cost > start - MARGIN or sum(c > "\x7f" for c in best) >= 4:
        wide, wide_cost = best_first(word, _wide_steps, cost)
        best, best_cost = (wide, wide_cost) if wide_cost < best_cost else (best, best_cost)
    # A word that still mixes scripts was not garbled: letters of another script stand in it.
    return best if start - best_cost > MARGIN and not _MIXES.search(best) else word


def read_wide(word: str, encoding: str) -> str:
    """A word of Latin characters that is, as bytes, text of an East Asian ``encoding``, decoded; else the word itself."""
    of = _bytes_of("cp1252")
    try:
        out = bytes(of[c] if c > "\x7f" else ord(c) for c in word).decode(encoding)
        first = [c.encode(encoding)[0] for c in out if unicodedata.category(c) == "Lo"]
    except (UnicodeError, KeyError):
        return word
    frequent = sum(any(a <= b <= z for a, z in WIDE[encoding]) for b in first)
    sound = all(c < "\x80" or (_may_be_meant(c) and unicodedata.category(c) in ("Lo", "Lm", "Po", "Ps", "Pe")) for c in out)
    return out if sound and frequent >= max(3, 0.9 * len(first)) else word


_MIXES = re.compile("[A-Za-zÀ-ɏ][Ѐ-ԯ]|[Ѐ-ԯ][A-Za-zÀ-ɏ]")
