"""Scalar text functions as column expressions: normalisation, identifiers, classification, predicates.

Everything here stays in the JVM but for ``compose`` (NFC and repair of misread UTF-8), which has no Spark built-in and is
applied to rows with characters beyond ASCII only (see ``operators.documents.clean``). White space means Unicode white space, as
``(?U)`` has it. Nulls give null unless a function says otherwise.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

from folioforge.functions.recode import WORD, repair_word

# Ligatures and their letters.
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st"}
# Beginnings of headings that are journal matter.
JUNK_HEADING = r"(?i)^(?:open\s+access|copyright|citation|reviewed\s+by\b|edited\s+by\b|\*?correspondence\b|received\s+\d|accepted\s+\d|published\s+\d|handling\s+editor\b|associate\s+editor\b|type\s)"
# Kinds of document that are not looked up.
LOCAL_TYPES = ("datasheet", "manual", "techreport", "notes", "other")
# Kinds of block that are neither summarised nor embedded.
SKIPPED_TYPES = ("section_header", "title", "author", "equation", "junk")

# Patterns of DOIs, captions, Markdown and formulas, and the lengths that go with them.
DOI = r"^10\.\d{4,}/[^\s<>\"}]+\z"
DOI_IN_TEXT = r"(?i)(?:doi:)?(10\.\d{4,}/[^\s<>\"},]+)"
CAPTION = r"(?i)^fig(?:ure)?\.?\s*\d+\s*[:.\-—–]\s*."
NUMBERED = r"(?U)^\d+[.\d]*[.\s]\s*[A-Z]"
SPACED = r"(?<![A-Za-z])([A-Za-z](?:(?U:\s)[A-Za-z]){3,})(?![A-Za-z])"
LINK = r"\[([^\]]+)\]\([^)]+\)"
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
MARKED_HEADING = r"(?U)^#{1,6}\s+(.+)"
LIST_LINE = r"(?U)^[-*]\s+"
DISPLAY = r"^\$\$[\s\S]+\$\$\z"
INLINE = r"^\$[^$]+\$\z"
LEAST_DISPLAY, LEAST_INLINE = 40, 80
HEADING_LENGTHS, CAPITALS_ABOVE = (3, 120), 5
# What is taken out of an author block, in this order, where it is cut, and how a name begins.
AUTHOR_NOISE = ((r"<sup>[^<]*</sup>", ""), (r"\*+", ""), ("[†‡§¶∗⊥#]", ""), (r"(?U)(\w)\d+(?:,\d+)*", "$1"), (r"(?U)\b\d+\b", ""), (r"(?U)\S+@\S+", ""), (r"(?Ui)^\s*and\s+", ""))
AUTHOR_CUT = r"(?U)[;,]|\band\b"
NAME_START = "^[A-Z\u00c0-\u024f]"
MOST_NAMES = 10
# Lines that end a title, and the size of a title.
IDENTIFIER_LINE = r"^arXiv:\d"
SECTION_LINE = "^(abstract|contents)"
DATE_LINE = r"(?U)^\d{1,2}(?:st|nd|rd|th)?\s+\w+\s+\d{4}"
MARKED_PEOPLE = r"(?U)[†‡§¶∗⊥#]|\d+[,∗]"
INITIAL = r"(?U)[A-Z]\.\s"
TITLE_LINES, TITLE_LINE_BELOW, TITLE_MOST = 3, 200, 300


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def blank_to_null(c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), c)


# --- normalisation --------------------------------------------------------------------------------------------------------


def _reread(m: re.Match) -> str:
    for encoding in ("cp1252", "latin-1"):
        try:
            return m[0].encode(encoding).decode("utf-8")
        except UnicodeError:
            continue
    return m[0]


#: UTF-8 sequences of two to four bytes as they look when read in a Western encoding.
_MISREAD = re.compile("[Â-ß][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|[à-ï][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{2}|[ð-ô][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{3}")
_C1 = re.compile("[\x80-\x9f]")


def compose_text(s: str | None) -> str | None:
    """Misread UTF-8 repaired where the sequences are valid in a Western encoding, or where the search over encodings finds a
    clearly better word; C1 controls read as what they are in the Western code page, line ends made one kind, then NFC. Greek,
    arrows, sub- and superscripts, primes and character references stay as they are."""
    if s is None or s.isascii() and "\r" not in s:
        return s
    for _ in range(3):
        t = _MISREAD.sub(_reread, s)
        if t == s:
            break
        s = t
    s = WORD.sub(lambda m: _repaired(m[0]) if not m[0].isascii() else m[0], s)
    s = _C1.sub(lambda m: m[0].encode("latin-1").decode("cp1252", "ignore") or m[0], s)
    s = s.replace("\r\n", "\n").replace("\r", "\n").replace("\u2028", "\n").replace("\u2029", "\n").replace("\u0085", "\n")
    return unicodedata.normalize("NFC", s)


@lru_cache(maxsize=100_000)
def _repaired(word: str) -> str:
    return repair_word(word)


@pandas_udf(StringType())
def compose(texts: pd.Series) -> pd.Series:
    return texts.map(compose_text, na_action="ignore")


@pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def join_spaced_letters(c: Column) -> Column:
    """Runs of four or more single letters, one white-space character apart, lose the blanks between them."""
    marked = F.regexp_replace(c, SPACED, "\ufdd0$1\ufdd1")
    parts = F.transform(F.split(marked, "\ufdd0"), lambda p: F.when(p.contains("\ufdd1"), F.concat(F.replace(F.substring_index(p, "\ufdd1", 1), F.lit(" "), F.lit("")), F.substring_index(p, "\ufdd1", -1))).otherwise(p))
    return F.when(marked.contains("\ufdd0"), F.array_join(parts, "")).otherwise(c)


def clean(c: Column) -> Column:
    """What follows composition: ligatures, spaced letters, odd spaces, invisible and control characters, line ends."""
    for ligature, letters in LIGATURES.items():
        c = F.replace(c, F.lit(ligature), F.lit(letters))
    c = join_spaced_letters(c)
    c = F.regexp_replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), "[\u00ad\ufeff\u200b\u200c\u200d\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(c, r"(?U)[^\S\n]+(?=\n|\z)", ""))


def strip_links(c: Column) -> Column:
    return strip(F.regexp_replace(c, LINK, "$1"))


def image_refs(c: Column) -> Column:
    """Targets of all image references, in order."""
    return F.regexp_extract_all(c, F.lit(IMAGE), 2)


# --- identifiers -----------------------------------------------------------------------------------------------------------


def normal_doi(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), "^doi:", "")


def valid_doi(c: Column) -> Column:
    return F.coalesce(c.rlike(DOI), F.lit(False))


def doi_in(c: Column) -> Column:
    """The first DOI in a text, or null."""
    return blank_to_null(F.regexp_extract(c, DOI_IN_TEXT, 1))


def paper_id(doi: Column, arxiv: Column, digest: Column) -> Column:
    """The first that is not empty; an error if all are."""
    found = F.coalesce(F.concat(F.lit("arxiv:"), blank_to_null(arxiv)), F.concat(F.lit("doi:"), blank_to_null(doi)), F.concat(F.lit("sha256:"), F.substring(blank_to_null(digest), 1, 12)))
    return F.coalesce(found, F.raise_error(F.lit("no identifier for a paper")).cast("string"))


def node_id(paper: Column, page: Column, index: Column) -> Column:
    return F.format_string("%s-p%02d-%03d", paper, page, index)


_ENDINGS = frozenset("a an and as at by for from in into new of on or the to via with".split())


def slug_text(names: list[str] | None, year: int | None, title: str | None) -> str:
    """Surname of the first author, year, first telling word of the title, in ASCII."""
    import hashlib

    def ascii_of(s: str) -> str:
        return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().lower()

    first = (names or [""])[0] or ""
    first = first.split(";")[0].strip()
    surname = first.split(",")[0] if "," in first else (first.split() or [""])[-1]
    surname = re.sub("[^a-z]", "", ascii_of(surname))[:30] or "anon"
    words = re.findall("[a-z0-9]+", ascii_of(title or ""))
    word = next((w for w in words if w not in _ENDINGS and w[0].isalpha()), "")
    if not word:
        word = "untitled" if not (title or "").strip() else hashlib.sha256(title.encode()).hexdigest()[:8]
    return f"{surname}{year or 0:04d}{word}"


@pandas_udf(StringType())
def slug(names: pd.Series, years: pd.Series, titles: pd.Series) -> pd.Series:
    rows = zip(names, years, titles, strict=True)
    return pd.Series([slug_text(None if n is None else list(n), None if pd.isna(y) else int(y), t) for n, y, t in rows])


# --- classification ---------------------------------------------------------------------------------------------------------


def is_caption(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(CAPTION), F.lit(False))


def is_junk_heading(c: Column) -> Column:
    return F.coalesce(c.rlike(JUNK_HEADING), F.lit(False))


def is_heading(c: Column) -> Column:
    """One short line that is in capitals or numbered, without a full stop."""
    n = F.length(c)
    plain = ~c.contains("\n") & n.between(*HEADING_LENGTHS) & ~c.endswith(".")
    return F.coalesce(plain & (((c == F.upper(c)) & (n > CAPITALS_ABOVE)) | c.rlike(NUMBERED)), F.lit(False))


def classify(chunk: Column) -> Column:
    """Struct (type, text) of a chunk of Markdown; type skip is for formulas too short to keep."""
    lines = F.split(chunk, "\n")
    first = F.element_at(lines, 1)
    filled = F.filter(lines, lambda x: x.rlike(r"(?U)\S"))
    image = "^" + IMAGE
    formula = F.regexp_replace(strip(F.regexp_replace(chunk, r"^\$+|\$+\z", "")), r"^\$+|\$+\z", "")
    kind = (
        F.when(first.rlike(MARKED_HEADING), "section_header")
        .when(first.rlike(image) & (F.size(lines) <= 2), "figure")
        .when((F.size(lines) >= 2) & F.forall(lines, lambda x: x.startswith("|")), "table")
        .when(chunk.rlike(DISPLAY), F.when(F.length(formula) < LEAST_DISPLAY, "skip").otherwise("equation"))
        .when(chunk.rlike(INLINE) & (F.length(chunk) < LEAST_INLINE), "skip")
        .when((F.size(filled) > 0) & F.forall(filled, lambda x: x.rlike(LIST_LINE)), "list")
        .otherwise("text")
    )
    text = F.when(kind == "section_header", strip(F.regexp_extract(first, MARKED_HEADING, 1))).when(kind == "figure", F.regexp_extract(first, image, 1)).otherwise(chunk)
    return F.struct(kind.alias("type"), text.alias("text"))


@pandas_udf(DoubleType())
def _latin_share_of(texts: pd.Series) -> pd.Series:
    def share(s: str) -> float | None:
        letters = sum(map(str.isalpha, s))
        plain = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
        return sum(map(str.isalpha, plain)) / letters if letters else None

    return texts.map(share, na_action="ignore")


def latin_share(c: Column) -> Column:
    """Letters that compatibility decomposition makes ASCII ones, as a share of all letters; null without letters. Only texts
    beyond ASCII go to Python: of others all letters are such."""
    beyond = F.octet_length(c) > F.length(c)
    return F.when(beyond, _latin_share_of(F.when(beyond, c))).when(c.rlike("[A-Za-z]"), 1.0)


def is_non_latin(c: Column) -> Column:
    """Whether fewer than half of the letters are Latin; blank texts and texts without letters are not."""
    return F.coalesce(latin_share(c) < 0.5, F.lit(False))


# What titles look like that no one gave: names of files, numbers of manuscripts, words of templates.
GARBAGE_TITLE = (
    r"(?i)^(?:.*\.(?:indd|qxd|qxp|fm|docx?|rtf|pdf|tex|dvi|eps|ps|pptx?)|microsoft word.*|powerpoint presentation|untitled(?:[ -]?\d*)?|slide \d+|no title|title|"
    r"(?:paper|article|manuscript|document) title|(?:type|insert|enter|your) (?:the )?(?:paper |article )?title(?: here)?|this is the title.*|(?:author )?(?:guide|instructions|guidelines)(?: for| to) .*|"
    r"prepar(?:e|ing|ation of) (?:papers|manuscripts|articles).*|(?:latex|revtex|word)(?: [0-9.]+)? (?:template|sample|author).*|(?:template|sample) (?:for|paper|article|manuscript).*|manuscript(?: no\.?| number| id)?[ :#]*[a-z0-9-]*\d[a-z0-9-]*|"
    r"[a-z]{1,8}[-_.]?\d{2,}[-_.a-z0-9]*|[a-z]{1,6}-[a-z]-\d{2}-\d+|pii:?.*)$"
)


def is_garbage_title(c: Column) -> Column:
    """Whether a title is none: the name of a file, the number of a manuscript, or left over from a template."""
    return F.coalesce(strip(c).rlike(GARBAGE_TITLE), F.lit(False))


# --- prompts and safety -----------------------------------------------------------------------------------------------------


def keyword(c: Column) -> Column:
    """Letters a to z of a word; null if fewer than two."""
    w = F.regexp_replace(F.lower(strip(c)), "[^a-z]", "")
    return F.when(F.length(w) >= 2, w)


def wrap_untrusted(c: Column, tag: str = "document") -> Column:
    inner = F.replace(F.replace(c, F.lit(f"<{tag}>"), F.lit(f"<{tag}_lit>")), F.lit(f"</{tag}>"), F.lit(f"</{tag}_lit>"))
    return F.concat(F.lit(f"<{tag}>\n"), inner, F.lit(f"\n</{tag}>"))


def canary(key: Column, prefix: str = "CANARY-") -> Column:
    """A token of eight hexadecimal digits that belongs to ``key``."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(key, 256), 1, 8)))


def canary_leaked(token: Column, response: Column) -> Column:
    return F.coalesce((token != "") & response.contains(token), F.lit(False))


def canary_removed(token: Column, response: Column) -> Column:
    return strip(F.replace(response, token, F.lit("")))


def prompt(title: Column, previous: Column, text: Column, most: int = 2000) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("Title: "), blank_to_null(title)), F.concat(F.lit("Previous: "), blank_to_null(previous)), F.substring(text, 1, most))


# --- small records -------------------------------------------------------------------------------------------------------------


def split_authors(c: Column) -> Column:
    """Names of an author string: by semicolons, else by "and", else one."""
    by = F.when(c.contains(";"), F.split(c, ";")).when(c.rlike("(?i) and "), F.split(c, "(?i) and ")).otherwise(F.array(c))
    return F.filter(F.transform(by, strip), lambda x: x != "")


def parse_authors(c: Column) -> Column:
    """Names on the first line of an author block without its marks, numbers and addresses; at most ten, null if none."""
    for pattern, by in AUTHOR_NOISE:
        c = F.regexp_replace(c, pattern, by)
    first = strip(F.element_at(F.split(c, "\n"), 1))
    names = F.filter(F.transform(F.split(first, AUTHOR_CUT), strip), lambda x: (F.length(x) > 2) & x.rlike(NAME_START))
    return F.when(F.size(names) > 0, F.slice(names, 1, MOST_NAMES))


def split_title(c: Column) -> Column:
    """Struct (title, authors) of a block in which title and authors run together: a fold over its lines.

    Lines of the title are taken (three at most) until a blank line, a heading of the abstract, a date, or a line of authors;
    the authors are read from the next three lines.
    """
    lines = F.split(c, "\n")
    # Leading identifier lines do not count.
    skip = F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s.n + F.when(s.on & strip(x).rlike(IDENTIFIER_LINE), 1).otherwise(0)).alias("n"), (s.on & strip(x).rlike(IDENTIFIER_LINE)).alias("on"))).n
    rest = F.slice(lines, skip + 1, F.greatest(F.size(lines) - skip, F.lit(0)))
    start = F.struct(F.array().cast("array<string>").alias("title"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("authors_at"), F.lit(False).alias("done"))

    def step(s: Column, line: Column) -> Column:
        x = strip(line)
        some = F.size(s.title) > 0
        heading = F.lower(x).rlike(SECTION_LINE) | x.rlike(DATE_LINE)
        people = x.rlike(MARKED_PEOPLE) | ((F.regexp_count(x, F.lit(",")) >= 2) & x.rlike(INITIAL))
        continues = (F.length(x) < TITLE_LINE_BELOW) & ~x.endswith(".")
        stop_here = heading | (people & some) | (~continues & some & ~people)
        blank = x == ""
        take = ~s.done & ~blank & ~stop_here
        title = F.when(take, F.concat(s.title, F.array(x))).otherwise(s.title)
        full = take & (F.size(title) >= TITLE_LINES)
        ends = ~s.done & ((blank & some) | (~blank & stop_here) | full)
        at = F.when(~s.done & ~blank & stop_here, s.i).when(ends, s.i + 1).otherwise(s.authors_at)
        return F.struct(title.alias("title"), (s.i + 1).alias("i"), at.alias("authors_at"), (s.done | ends).alias("done"))

    got = F.aggregate(rest, start, step)
    title = F.when(F.size(got.title) > 0, F.substring(F.array_join(got.title, " "), 1, TITLE_MOST))
    below = F.when(got.authors_at < F.size(rest), F.array_join(F.slice(rest, got.authors_at + 1, 3), "\n"))
    return F.struct(title.alias("title"), F.when(title.isNotNull(), parse_authors(below)).alias("authors"))


def citation(journal: Column, year: Column) -> Column:
    return F.concat_ws(", ", blank_to_null(journal), year.cast("string"))


def supplement_name(stem: Column) -> Column:
    """What follows the last underscore, in lower case; null without one."""
    return F.when(stem.contains("_"), F.lower(F.substring_index(stem, "_", -1)))


def tags_of(path: Column, root: str) -> Column:
    """Directories between the root and the file, without the work folders; none outside the root."""
    inside = path.startswith(root.rstrip("/") + "/")
    parts = F.split(F.substring(path, F.lit(len(root.rstrip("/")) + 2), F.length(path)), "/")
    dirs = F.filter(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: ~F.lower(x).isin("completed", "errors", "duplicates") & (x != ""))
    return F.when(inside, dirs).otherwise(F.array().cast("array<string>"))
