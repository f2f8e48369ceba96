"""Text that was decoded with the wrong character encoding (problem 5).

Method: best-first search over strings. An operation writes a string's characters as the bytes of some encoding and reads
those bytes as another one, or resolves character references; states already seen (by hash) are not visited again. A cost of
implausible characters guides the search: the cheapest string reached is the repair, if it is clearly cheaper than the given
one. The search is made over two kinds of strings:

* words (``functions/recode.py``), whose operations undo UTF-8 that was read as another encoding (single-byte or East Asian), East Asian text that was
  read as Latin, and character references. Their cost are properties of characters and their neighbours: control characters of
  the C1 block, replacement characters, box drawing, symbols that touch letters, runs of marked Latin letters, capitals inside
  words, scripts mixed within a word;
* runs of words without ASCII letters, where one single-byte encoding was mistaken for another and every character is still a
  letter. Their operations swap encodings, their cost are the letter pairs of Cyrillic, Greek, Hebrew and Arabic, counted over
  all texts and over some general sentences.

Operations on words make them shorter, and swaps end after two, so every search ends by itself. Partly garbled strings are
handled too: an operation replaces only those places that form valid sequences.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.recode import LOST, WORD, best_first, repair_word

# Pairs of single-byte encodings that are mistaken for each other.
SWAPPED = (
    ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("mac_roman", "cp1251"), ("cp1252", "mac_cyrillic"), ("cp1252", "cp1253"), ("cp437", "cp866"),
    ("cp1252", "iso8859_5"), ("cp1252", "iso8859_7"), ("cp1252", "cp1255"), ("cp1252", "cp1256"), ("cp1252", "iso8859_6"), ("mac_roman", "cp1253"), ("cp437", "cp737"), ("cp1251", "cp1253"), ("cp1251", "cp1255"), ("cp1251", "cp1256"), ("cp850", "cp866"),
)
# Sentences of general prose (from the Universal Declaration of Human Rights) in alphabets that are taken for each other.
GENERAL = """
Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.
Каждый человек должен обладать всеми правами и всеми свободами без какого бы то ни было различия, как-то в отношении расы, цвета кожи, пола, языка, религии, политических или иных убеждений.
Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность. Никто не должен содержаться в рабстве. Все люди равны перед законом и имеют право на равную защиту закона.
Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і совістю і повинні діяти у відношенні один до одного в дусі братерства.
Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.
כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה.
يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء.
"""
_LETTERS = "(?:[^\\W\\d_a-zA-Z]|[÷¸¨╦╗])"  # the five are what letters of Cyrillic encodings look like
_FOREIGN_RUN = re.compile(rf"{_LETTERS}+(?:[ \n,()«»\"'’-]+{_LETTERS}+)*")


# --- letter pairs of non-Latin scripts -----------------------------------------------------------------------------------


_ALPHABETS = "Ѐ-џͰ-Ͽ\u05d0-\u05ea\u0621-\u064a"


def _count_pairs(words: Counter[str]) -> Counter[str]:
    pairs: Counter[str] = Counter()
    for word, n in words.items():
        # Words in capitals are left out: that is how one of the swapped encodings shows.
        if word[1:].islower() or not (word[0].islower() or word[0].isupper()):
            low = f" {word.lower()} "
            for a, b in zip(low, low[1:], strict=False):
                pairs[a + b] += n
    return pairs


def general_pairs() -> Counter[str]:
    """Letter pairs of the general sentences."""
    return _count_pairs(Counter(re.findall(f"[{_ALPHABETS}]{{2,}}", GENERAL)))


def pair_counts(texts: DataFrame) -> dict[str, float]:
    """Log probabilities of letter pairs (case folded) of Cyrillic, Greek, Hebrew and Arabic words, counted over all ``texts``
    (text) and the general sentences, each alphabet for itself.

    The result has at most as many entries as these alphabets have pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update(re.findall(f"[{_ALPHABETS}]{{2,}}", text))
            if len(words) > 200_000:
                yield flush(words)
        yield flush(words)

    def flush(words: Counter[str]) -> pa.RecordBatch:
        pairs = _count_pairs(words)
        words.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["pair", "n"])

    rows = texts.filter(F.col("text").rlike(f"[{_ALPHABETS}]{{2}}")).select("text").mapInArrow(run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counted = general_pairs()
    for r in rows:
        counted[r["pair"]] += r["n"]
    return log_probabilities(counted)


def log_probabilities(counted: Counter[str]) -> dict[str, float]:
    total: Counter[str] = Counter()
    alphabet = {pair: max(pair)[0] > "\u0590" and ("he" if max(pair) < "\u0600" else "ar") or ("el" if max(pair) < "\u0400" else "ru") for pair in counted}
    for pair, n in counted.items():
        total[alphabet[pair]] += n
    return {pair: math.log(n / total[alphabet[pair]]) for pair, n in counted.items()}


_LETTER_WORDS = re.compile(r"[^\W\d_]+")


class _Words(dict):
    """The likelihood of words, remembered, as most are met again and again."""

    def __init__(self, pairs: dict[str, float]) -> None:
        super().__init__()
        self.pairs = pairs

    def __missing__(self, word: str) -> float:
        if len(self) > 200_000:
            self.clear()
        low, get = f" {word.lower()} ", self.pairs.get
        value = self[word] = sum(get(a + b, -14.0) for a, b in zip(low, low[1:], strict=False))
        return value


def _likelihood(run: str, words: _Words) -> tuple[float, int]:
    found = _LETTER_WORDS.findall(run)
    return sum(words[w] for w in found), sum(map(len, found)) + len(found)


def repair_run(run: str, words: _Words) -> str:
    """A run of words without ASCII letters in which single-byte encodings may have been mistaken.

    Garbled and sound words may stand side by side: the run is cut where the script or the way of writing capitals changes, and
    each part is searched by itself.
    """
    if not words.pairs:
        return run
    parts: list[list] = []
    for token in re.findall(rf"{_LETTERS}+|(?:(?!{_LETTERS}).)+", run, re.DOTALL):
        is_word = bool(re.match(_LETTERS, token))
        kind = (token[0] < "\u0370" or token[0] in "╦╗", len(token) > 1 and not token[1:].islower()) if is_word and len(token) > 1 else None
        if parts and (kind is None or parts[-1][0] is None or parts[-1][0] == kind):
            parts[-1][0] = parts[-1][0] if kind is None else kind
            parts[-1][1] += token
        else:
            parts.append([kind, token])
    return "".join(_repair_part(text, words) for _, text in parts)


def _repair_part(run: str, words: _Words) -> str:
    letters = len(re.findall(_LETTERS, run))
    if letters < 4:
        return run

    def swaps(s: str, depth: int) -> Iterator[tuple[str, bool, float]]:
        # A second swap is tried only where the first made it better.
        for right, wrong in SWAPPED if not depth or (depth == 1 and price(s) < price(run)) else ():  # written as the bytes of one, read as the other
            try:
                t = s.encode(right).decode(wrong)
            except UnicodeError:
                continue
            if not re.search(r"[\x80-\x9f─-▟]", t) and sum(map(str.isalpha, t)) >= letters:
                yield t, True, 0.0 if not depth else 4.0

    def price(s: str) -> float:
        # The right text is mostly small letters, or has none that are small or large.
        shouted = sum(1 for w in _LETTER_WORDS.findall(s) if len(w) > 1 and not w[1:].islower() and w[1:].lower() != w[1:].upper())
        return 3.0 * shouted - _likelihood(s, words)[0]

    own, n = _likelihood(run, words)
    best, best_cost = best_first(run, swaps, price)
    return best if -best_cost - own > 1.0 * n and -best_cost / n > -8.5 else run


class Repairer:
    """Repairs texts; remembers the words seen, as most are met again and again."""

    def __init__(self, pairs: dict[str, float]) -> None:
        self.likely = _Words(pairs)
        self.words: dict[str, str] = {}

    def word(self, w: str) -> str:
        got = self.words.get(w)
        if got is None:
            if len(self.words) > 200_000:
                self.words.clear()
            got = self.words[w] = repair_word(w)
        return got

    def repair(self, text: str) -> tuple[str, bool]:
        """(the text as far as it can be restored, whether any of it was garbled)."""
        fixed = WORD.sub(lambda m: self.word(m[0]), text)
        if len(re.findall(_LETTERS, fixed)) >= 4:
            fixed = _FOREIGN_RUN.sub(lambda m: repair_run(m[0], self.likely), fixed)
        return fixed, fixed != text or bool(LOST.search(text)) or _dangling(text)


_STRAY = re.compile(r"(?:(?<=[a-zß-ÿ])|(?<![^\W\d_]))[ÃÂ](?=[ \n]|$)|[a-z][√├Γ][a-z ]")


def _dangling(text: str) -> bool:
    """A lead byte whose continuation was lost, as by a blank."""
    return bool(_STRAY.search(text))


def repair_texts(records: DataFrame, pairs: dict[str, float]) -> DataFrame:
    """(record_kind, record_id, repaired) of the garbled ones among ``records`` (record_kind, record_id, text).

    Null, empty and pure ASCII texts without character references are never garbled. Repeated rows each give their row.
    """
    shared = records.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(shared.value)
        for batch in batches:
            keep, texts = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                fixed, garbled = repairer.repair(text)
                if garbled:
                    keep.append(i)
                    texts.append(fixed)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep, pa.int32())) for c in batch.columns[:2]), pa.array(texts, pa.string())], names=["record_kind", "record_id", "repaired"])

    return possibly_garbled(records).mapInArrow(run, "record_kind string, record_id long, repaired string")


def possibly_garbled(records: DataFrame) -> DataFrame:
    """Texts with characters beyond ASCII or with references to such."""
    beyond = F.octet_length("text") > F.length("text")
    return records.select("record_kind", "record_id", "text").filter(beyond | F.col("text").rlike("&(#[0-9xX]|[A-Z][a-z]+;|acirc;|euro;)"))


def records_of(blocks: DataFrame, papers: DataFrame) -> DataFrame:
    """Block texts and paper titles as (record_kind, record_id, text)."""
    return blocks.select(F.lit("block").alias("record_kind"), F.col("block_id").alias("record_id"), "text").unionByName(papers.select(F.lit("paper").alias("record_kind"), F.col("bundle_id").alias("record_id"), F.col("title").alias("text")))
