"""Noise in text from scanned pages (problem 6).

Repairs words broken over line ends, misread letters, running headers and page numbers, and gives continuous paragraphs.

Method. Word and word-pair frequencies are counted over all texts. A symmetric-delete index over the lexicon gives correction
candidates of rare words: two words meet where both become equal by up to two deletions, with the deletions at the same
places (a key marks each gap, so that keys of short words are no large groups). A weighted edit distance, cheap for pairs that
scanners confuse (m and rn, l and 1) and dear for all else, keeps those that are misreadings, and the word pairs choose: a
repair must stand in company in which its word is known. Line ends with a break mark are joined unless the lexicon has the
hyphenated word more often. All decisions are about distinct words; they are applied to the texts in one pass.

Words above ``longest`` letters would have too many deletions: they meet in one of seven segments, one of which at least three
confusions leave whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.segment_join import cut
from folioforge.session import checkpointed

# What scanners confuse, as (printed, read), either way round.
CONFUSED = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("s", "5"), ("g", "9"), ("b", "6"), ("b", "8"), ("z", "2"), ("i", "l"), ("e", "c"), ("t", "f"), ("m", "rn"), ("n", "ri"), ("h", "li"), ("u", "ii"), ("d", "cl"), ("w", "vv"),
    ("B", "8"), ("S", "5"), ("O", "0"), ("I", "l"), ("I", "1"), ("G", "6"), ("Z", "2"), ("t", "r"), ("a", "o"), ("h", "b"), ("n", "u"), ("v", "y"), ("q", "g"), ("k", "lc"), ("m", "nn"), ("f", "r"), ("l", "t"), ("i", "j"), ("U", "LI"), ("o", "c"),
)
#: Of these the first seventeen are common; the others are counted a little dearer.
COMMON = 17
#: Words nearer than this are taken for misread: three common confusions, or a common and an uncommon one.
MISREAD_BELOW = 0.8
BREAK_MARKS = "\\-¬‐‑\u00ad"


@dataclass(frozen=True)
class ScanPlan:
    """``rarer``: a misread word is so many times rarer than the right one. ``longest``: words of more letters are looked up
    by segments instead of deletions. ``most_decisions``: up to so many distinct decisions are broadcast;
    beyond, they are joined to the texts by word, with the same result. ``most_frequent``: so many of the most frequent words
    are left out of that join beforehand, unless a decision is about them."""

    rarer: int = 40
    deletions: int = 2
    longest: int = 24
    most_decisions: int = 400_000
    most_frequent: int = 10_000


_TOKEN = re.compile(r"[^\W_]+")
_BROKEN = re.compile(rf"([^\W\d_]+)[{BREAK_MARKS}][ \t]*\n+[ \t]*(?=(\w+))")
#: Both parts of a broken word: neither is a word to be counted.
_BROKEN_WHOLE = re.compile(_BROKEN.pattern.replace("(?=(\\w+))", "(\\w+)"))
#: Characters without width: words go on behind them.
_NO_WIDTH = dict.fromkeys(map(ord, "\u00ad\u200b\u200c\u200d\u2060\ufeff"))
_COMPOUND = re.compile(r"[^\W\d_]+-[^\W\d_]+")

_NUMBER = r"(?:\d{1,4}|(?=[ivxl])(?-i:(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})))"
_PAGE = re.compile(rf"(?:page|p\.?|pp\.?|seite|pág\.?|página|стр\.?|с\.)\s*\d{{1,4}}(?:\s*(?:of|von|de|/)\s*\d{{1,4}})?|[-–—]+\s*{_NUMBER}\s*[-–—]+|\[\s*{_NUMBER}\s*\]|\(\s*\d{{1,4}}\s*\)|{_NUMBER}(?:\s*/\s*\d{{1,4}})?", re.IGNORECASE)
_EDGE_NUMBER = re.compile(r"^\d{1,4}(?:\s{2,}|\s*\|\s*)|(?:\s{2,}|\s*\|\s*)\d{1,4}$")
_VOLUME = re.compile(r"vol\.?\s*\d+\s*[,;.]?\s*(?:no\.?|nr\.?|issue)\s*\d+.{0,20}", re.IGNORECASE)
_ET_AL = re.compile(r"[^\W\d_]+(?:[-'’ ][^\W\d_]+){0,2},? et al\.?", re.IGNORECASE)
_SMALL_WORDS = frozenset("of on in and the for de la des der die und für du et y da e do".split())
_MARKUP_LINE = re.compile(r"[#*+>|{}\\<`$~=\[!:;]|^-{3,}|^-\s")


def _is_title(s: str) -> bool:
    """Words all in capitals, or all with capitals but the small ones."""
    words = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", s)
    if len(words) < 2 or s[-1:] in ".!?;:" or _MARKUP_LINE.match(s) or "=" in s:
        return False
    if s == s.upper() and sum(map(len, words)) >= 8:
        return True
    return len(words) >= 3 and words[0][0].isupper() and all(w[0].isupper() or w in _SMALL_WORDS for w in words) and not re.search(r"[.,;:!?]", s) and not re.search(r"\d", s)


def _key(s: str) -> str:
    return " ".join(re.findall(r"\w+", s.lower()))


def _is_own_title(line: str, before: str, after: str, titles: tuple[str, ...]) -> bool:
    """Whether a line is the title of its paper or the beginning of it, and not a sentence that begins like it: it has no full
    stop, the text does not go on as the title does, and it is whole, cut within a word, or in the middle of a sentence."""
    key = _key(line)
    if line[-1] in ".!?;:,":
        return False
    if len(key) < 15 or key.count(" ") < 2:  # a short one must be whole and stand in the middle of a sentence
        return key in titles and len(key) > 3 and _interrupts(before, after) and after[0].islower()
    following = _key(after)
    for title in titles:
        if title.startswith(key):
            rest = title[len(key) :]
            goes_on = bool(rest.split()) and following.startswith(rest.split()[0])
            if not goes_on and (not rest.startswith(" ") or (before and before[-1] not in ".!?:…")):
                return True
    return False


def noise_lines(lines: list[str], titles: tuple[str, ...] = ()) -> list[bool]:
    """Which lines of a block of several lines are running headers or page numbers. ``titles`` are those of its paper, as
    ``_key`` writes them."""
    out = [False] * len(lines)
    if len(lines) < 2:
        return out
    # The lines before and behind that are not blank.
    bare_lines = [x.strip() for x in lines]
    befores, afters, last = [], [""] * len(lines), ""
    for x in bare_lines:
        befores.append(last)
        last = x or last
    last = ""
    for i in range(len(lines) - 1, -1, -1):
        afters[i] = last
        last = bare_lines[i] or last
    fenced = False
    for i, s in enumerate(bare_lines):
        if re.match(r"```|~~~|<pre|\{\||\\begin|\$\$", s):
            fenced = not re.search(r"</pre>|.\$\$$", s)
        if fenced:
            fenced = not re.match(r"\|\}|\\end", s)
            continue
        if not s:
            continue
        before, after = befores[i], afters[i]
        if re.fullmatch(r"[=\-~^]{3,}", after) or _MARKUP_LINE.match(before[:1] or " ") and before[:1] in "`~{|":
            continue
        bare = _EDGE_NUMBER.sub("", s).strip()
        if _PAGE.fullmatch(s) or _VOLUME.fullmatch(bare) or _ET_AL.fullmatch(bare):
            out[i] = True
        elif bare != s and len(re.findall(r"[^\W\d_]{2,}", bare)) >= 2 and bare[-1] not in ".!?;:," and not _MARKUP_LINE.match(s):
            out[i] = True  # a page number set off from words
        elif _is_title(bare) and (i in (0, len(lines) - 1) or _interrupts(before, after) or bare == bare.upper() or (lines[i - 1].strip() and lines[i + 1].strip())):
            out[i] = True  # a heading would have a blank line before or behind it
        elif titles and not _MARKUP_LINE.match(s) and _is_own_title(bare, before, after, titles):
            out[i] = True
    return out


def _interrupts(before: str, after: str) -> bool:
    return bool(before and after) and before[-1] not in ".!?:"


def _flow(text: str, titles: tuple[str, ...] = ()) -> str:
    """The text without noise lines, with its line ends."""
    lines = text.split("\n")
    drop = noise_lines(lines, titles)
    return "\n".join(x for x, d in zip(lines, drop, strict=True) if not d) if any(drop) else text


# --- counting ---------------------------------------------------------------------------------------------------------------


def counts(texts: DataFrame) -> DataFrame:
    """(kind, a, b, n) over all ``texts`` (text): kind 0 words, 1 neighbouring words, 2 hyphenated words, 3 words broken over
    a line end, 4 the same joined: they may be misread like any other, but are no evidence of a word. Words are counted in
    lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, compounds, broken, joined = (Counter() for _ in range(5))

        def flush() -> pa.RecordBatch:
            rows = [(0, w, "", n) for w, n in words.items()] + [(1, a, b, n) for (a, b), n in pairs.items()]
            rows += [(2, w, "", n) for w, n in compounds.items()] + [(3, a, b, n) for (a, b), n in broken.items()] + [(4, w, "", n) for w, n in joined.items()]
            for c in (words, pairs, compounds, broken, joined):
                c.clear()
            types = (pa.int32(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, types, strict=True)], names=["kind", "a", "b", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text.isascii():
                    text = text.translate(_NO_WIDTH)
                whole = text
                if "\n" in text:
                    text = whole = _flow(text)
                    parts = [(m[1].lower(), m[2].lower()) for m in _BROKEN.finditer(text)]
                    if parts:
                        broken.update(parts)
                        joined.update(a + b for a, b in parts)
                        whole = _BROKEN.sub(r"\1", text)
                        text = _BROKEN_WHOLE.sub(" . ", text)
                if "-" in text:
                    compounds.update(m.lower() for m in _COMPOUND.findall(text))
                found = _TOKEN.findall(text.lower())
                words.update(found)
                if whole is not text:
                    found = _TOKEN.findall(whole.lower())
                pairs.update(zip(found, found[1:], strict=False))
            if len(pairs) > 300_000:
                yield flush()
        yield flush()

    return texts.select("text").mapInArrow(run, "kind int, a string, b string, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


# --- decisions ----------------------------------------------------------------------------------------------------------------


_GAP = "_"


def deletes(word: str, most: int) -> set[str]:
    """All strings that come from ``word`` by up to ``most`` deletions, each run of them marked by a gap."""
    out = {word}
    if most and len(word) > 2:
        out.update(word[:i] + _GAP + word[i + 1 :] for i in range(len(word)))
    if most > 1 and len(word) > 3:
        out.update(word[:i] + _GAP + word[i + 2 :] for i in range(len(word) - 1))
        out.update(word[:i] + _GAP + word[i + 1 : j] + _GAP + word[j + 1 :] for i in range(len(word)) for j in range(i + 2, len(word)))
    return out


#: A misreading has at most so many confusions, see MISREAD_BELOW; each spoils two of the segments at most and moves by one.
_MOST_CONFUSIONS = 3


def _segment_keys(word: str, lengths: range, shifts: range) -> set[str]:
    """Keys of the segments of a long word, as a word of any of ``lengths`` would be cut, moved by any of ``shifts``."""
    out = set()
    for length in lengths:
        for i, (at, n) in enumerate(cut(length, 2 * _MOST_CONFUSIONS + 1)):
            out.update(f"{length}:{i}:{xxhash.xxh3_64_hexdigest(word[at + x : at + x + n])}" for x in shifts if 0 <= at + x <= len(word) - n)
    return out


def lookup_keys(word: str, plan: ScanPlan, *, index: bool) -> set[str]:
    """Where a right word stands in the index, or a read one looks: deletions, of long words segments."""
    if len(word) <= plan.longest - _MOST_CONFUSIONS:
        return deletes(word, plan.deletions)
    k = _MOST_CONFUSIONS
    long = _segment_keys(word, range(len(word), len(word) + 1), range(1)) if index else _segment_keys(word, range(len(word) - k, len(word) + k + 1), range(-k, k + 1))
    return long | deletes(word, plan.deletions) if len(word) <= plan.longest + k else long


_SWAPS = [(a, b, 0.25 if i < COMMON else 0.45) for i, pair in enumerate(CONFUSED) for a, b in (pair, pair[::-1])]


def misreading(right: str, read: str) -> float:
    """Weighted edit distance: confusions cost 0.25 or 0.45, all other edits 1."""
    far, band = 9.0, 4  # what is dearer than two has no more than eight confusions, each moves by one letter at most; beyond the band all is dear
    if abs(len(right) - len(read)) > band:
        return far
    d = [[far] * (len(read) + 1) for _ in range(len(right) + 1)] if len(right) < 64 else [_Row(far) for _ in range(len(right) + 1)]
    d[0][0] = 0.0
    for i in range(len(right) + 1):
        for j in range(max(0, i - band), min(len(read), i + band) + 1):
            here = d[i][j]
            if here >= 2:
                continue
            if i < len(right) and j < len(read):
                d[i + 1][j + 1] = min(d[i + 1][j + 1], here + (right[i] != read[j]))
            if i < len(right):
                d[i + 1][j] = min(d[i + 1][j], here + 1)
            if j < len(read):
                d[i][j + 1] = min(d[i][j + 1], here + 1)
            for a, b, price in _SWAPS:
                if right.startswith(a, i) and read.startswith(b, j):
                    d[i + len(a)][j + len(b)] = min(d[i + len(a)][j + len(b)], here + price)
    return d[len(right)][len(read)]


class _Row(dict):
    """A row of a large table of which only the band is filled."""

    def __init__(self, far: float) -> None:
        super().__init__()
        self.far = far

    def __missing__(self, key: int) -> float:
        return self.far


def _delete_keys(words: DataFrame, plan: ScanPlan, name: str, *, index: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, own, ns = [], [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k in lookup_keys(word, plan, index=index):
                    keys.append(k)
                    own.append(word)
                    ns.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(own, pa.string()), pa.array(ns, pa.int64())], names=["key", name, f"n_{name}"])

    return words.mapInArrow(run, f"key string, {name} string, n_{name} long")


def misread_words(counted: DataFrame, plan: ScanPlan) -> DataFrame:
    """(a, b): the misread word a means b."""
    sound = counted.filter((F.col("kind") == 0) & (F.length("a") >= 3)).select("a", "n")
    words = sound.unionByName(counted.filter((F.col("kind") == 4) & (F.length("a") >= 3)).select("a", "n")).groupBy("a").agg(F.sum("n").alias("n"))
    top = sound.filter(~F.col("a").rlike("[0-9]"))
    # A rare word can only be a misreading of one that is ``rarer`` times as frequent.
    limit = (top.agg(F.max("n")).first()[0] or 0) // plan.rarer
    # Words of three letters are too much alike; with a digit among them they are asked nevertheless.
    read = _delete_keys(words.filter((F.col("n") <= limit) & ((F.length("a") > 3) | F.col("a").rlike("[0-9]"))), plan, "read", index=False)
    right = _delete_keys(top.filter(F.col("n") >= plan.rarer // 10), plan, "right", index=True)
    # A digit among letters is a misreading by itself; there the right word need not be so frequent. Only the ratio counts, no
    # number of occurrences: the same misreading is found in tables of any size.
    rarer = F.when(F.col("read").rlike(r"\p{L}[0-9]|[0-9]\p{L}{2}"), plan.rarer // 10).otherwise(plan.rarer)
    candidates = read.join(right, "key").filter(F.col("n_read") * rarer <= F.col("n_right")).select("read", "right", "n_right").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            price = [misreading(b, a) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(price, pa.float64())], names=["read", "right", "n_right", "price"]).filter(pa.array([p < MISREAD_BELOW for p in price], pa.bool_()))

    kept = checkpointed(candidates.mapInArrow(verify, "read string, right string, n_right long, price double"))
    # Company: of the word pairs in which the read word stands, the share that is known with the right word in its place.
    pairs = counted.filter("kind = 1").select("a", "b", "n")
    known = pairs.filter(F.col("n") >= 2)
    behind = kept.join(pairs.select(F.col("b").alias("read"), F.col("a").alias("other"), "n"), "read").join(known.select(F.col("b").alias("right"), F.col("a").alias("other"), F.lit(1).alias("hit")), ["right", "other"], "left")
    ahead = kept.join(pairs.select(F.col("a").alias("read"), F.col("b").alias("other"), "n"), "read").join(known.select(F.col("a").alias("right"), F.col("b").alias("other"), F.lit(1).alias("hit")), ["right", "other"], "left")
    company = behind.unionByName(ahead).groupBy("read", "right", "n_right", "price").agg((F.sum(F.when(F.col("hit").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    best = company.filter("share >= 0.3").groupBy("read").agg(F.max_by("right", F.struct("share", -F.col("price"), "n_right", "right")).alias("right"))
    return best.select(F.col("read").alias("a"), F.col("right").alias("b"))


def broken_words(counted: DataFrame) -> DataFrame:
    """(a, b, keep) of words broken over a line end after a: whether the mark belongs to the word."""
    broken = counted.filter("kind = 3").select("a", "b")
    joined = counted.filter("kind = 0").select(F.col("a").alias("joined"), F.col("n").alias("n_joined"))
    hyphened = counted.filter("kind = 2").select(F.col("a").alias("hyphened"), F.col("n").alias("n_hyphened"))
    both = broken.withColumns({"joined": F.concat("a", "b"), "hyphened": F.concat_ws("-", "a", "b")}).join(joined, "joined", "left").join(hyphened, "hyphened", "left")
    n_joined, n_hyphened = F.coalesce("n_joined", F.lit(0)), F.coalesce("n_hyphened", F.lit(0))
    return both.select("a", "b", (n_hyphened > n_joined).alias("keep")).filter("keep")


# --- repair -------------------------------------------------------------------------------------------------------------------


def _like(case: str, word: str) -> str:
    if len(case) > 1 and case.isupper():
        return word.upper()
    return word[:1].upper() + word[1:] if case[:1].isupper() else word


def repair_text(text: str, misread: dict[str, str], kept: set[str], titles: tuple[str, ...] = ()) -> tuple[str, bool]:
    """(continuous paragraphs, whether there was noise). Line ends alone are no noise; without noise the text is unchanged."""
    noisy = False

    def join(m: re.Match) -> str:
        nonlocal noisy
        if f"{m[1].lower()}-{m[2].lower()}" in kept:
            return m[1] + "-"
        noisy = True
        return m[1]

    out = text
    if "\n" in text:
        flow = _flow(text, titles)
        noisy = flow is not text
        out = _BROKEN.sub(join, flow)
    seen = out if out.isascii() else out.translate(_NO_WIDTH)
    words = set(_TOKEN.findall(seen.lower()))
    wrong = words & misread.keys() if len(words) < len(misread) else {w for w in words if w in misread}
    if wrong:
        noisy = True
        out = _TOKEN.sub(lambda m: _like(m[0], misread[w]) if (w := m[0].lower()) in wrong else m[0], seen)
    if not noisy:
        return text, False
    if not re.search(r"```|~~~|\{\||\\begin|<[a-z]", out):
        paragraphs = re.split(r"\n[ \t]*\n+", out)
        out = "\n\n".join(re.sub(r"[ \t]*\n(?![-*#|>])[ \t]*", " ", p).strip() for p in paragraphs if p.strip())
    return out, True


def repair_blocks(blocks: DataFrame, papers: DataFrame | None = None, plan: ScanPlan | None = None) -> DataFrame:
    """(block_id, repaired) of the noisy ones among ``blocks`` (block_id, paper_id, type, text); ``papers`` (paper_id, title,
    journal) tells the titles that may run as headers.

    Null and empty texts and tables and equations have no noise; repeated rows each give their row. A text of one line can
    only have misread words.
    """
    plan = plan or ScanPlan()
    texts = blocks.select("block_id", "paper_id", "text").filter(F.col("text").isNotNull() & ~F.coalesce(F.col("type"), F.lit("")).isin("table", "equation"))
    counted = checkpointed(counts(texts))
    decisions = checkpointed(misread_words(counted, plan).select("a", "b").unionByName(broken_words(counted).select(F.concat_ws("-", "a", "b").alias("a"), F.lit(None).cast("string").alias("b"))))
    # Only texts of several lines are asked for headers: few, so their titles come by a join.
    none = F.lit(None).cast("array<string>").alias("titles")
    lined = texts.filter(F.col("text").contains("\n"))
    if papers is not None:
        heads = papers.select("paper_id", F.explode(F.array("title", "journal")).alias("title"))
        titles = heads.filter("paper_id is not null and length(title) > 3").distinct().groupBy("paper_id").agg(F.collect_list("title").alias("titles"))
        lined = lined.join(titles, "paper_id", "left").select("block_id", "text", "titles")
    else:
        lined = lined.select("block_id", "text", none)
    source = lined.unionByName(texts.filter(~F.col("text").contains("\n")).select("block_id", "text", none))

    def run_with(get) -> callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, out = [], []
                for i, (key, text, titles) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)):
                    repaired, noisy = repair_text(text, *get(batch, i), tuple(map(_key, titles or ())))
                    if noisy:
                        ids.append(key)
                        out.append(repaired)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["block_id", "repaired"])

        return run

    if decisions.limit(plan.most_decisions + 1).count() <= plan.most_decisions:
        rows = decisions.collect()  # at most ``most_decisions`` words
        shared = blocks.sparkSession.sparkContext.broadcast(({r["a"]: r["b"] for r in rows if r["b"]}, {r["a"] for r in rows if not r["b"]}))
        return source.mapInArrow(run_with(lambda batch, i: shared.value), "block_id long, repaired string")
    # Too many for a broadcast: every block gets those decisions that concern its own words, by a join on the word. The words are
    # those that ``repair_text`` may look up, written by the same code. The most frequent words of the corpus, about which
    # there is no decision, stay out of the join: they would be its hot keys.
    frequent = counted.filter("kind = 0").orderBy(F.desc("n"), "a").limit(plan.most_frequent).select("a")
    idle = {r["a"] for r in frequent.join(decisions.select("a"), "a", "left_anti").collect()}
    left_out = blocks.sparkSession.sparkContext.broadcast(frozenset(idle))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, asked = [], []
            for row, text, titles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = looked_up(text, tuple(map(_key, titles or ()))) - left_out.value
                rows += [row] * len(own)
                asked += own
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(asked, pa.string())], names=["row", "a"])

    keyed = checkpointed(source.withColumn("row", F.monotonically_increasing_id()))
    tokens = keyed.select("row", "text", "titles").mapInArrow(ask, "row long, a string")
    own = tokens.join(decisions, "a").groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("own"))
    with_own = keyed.join(own, "row", "left").select("block_id", "text", "titles", "own")

    def from_column(batch: pa.RecordBatch, i: int) -> tuple[dict[str, str], set[str]]:
        rows = batch.column(3)[i].as_py() or []
        return {r["a"]: r["b"] for r in rows if r["b"]}, {r["a"] for r in rows if not r["b"]}

    return with_own.mapInArrow(run_with(from_column), "block_id long, repaired string")


def looked_up(text: str, titles: tuple[str, ...] = ()) -> set[str]:
    """Every word that ``repair_text`` may look up: those of the text with its broken words joined, those with them kept
    apart, and the hyphenated ones."""
    if "\n" not in text:
        return set(_TOKEN.findall((text if text.isascii() else text.translate(_NO_WIDTH)).lower()))
    flow = _flow(text, titles)
    out = {f"{m[1].lower()}-{m[2].lower()}" for m in _BROKEN.finditer(flow)}
    for t in (_BROKEN.sub(r"\1", flow), _BROKEN.sub(r"\1-", flow)):
        out.update(_TOKEN.findall((t if t.isascii() else t.translate(_NO_WIDTH)).lower()))
    return out
