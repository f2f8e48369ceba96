"""Operators on tables of texts: cleaning, paragraphs, chunks."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from folioforge.functions import text as T

# Separators in the order in which they are tried, and sizes in characters.
SEPARATORS = ("\n\n", "\n", ". ", ", ", " ")
CHUNK_SIZE, OVERLAP, TABLE_SIZE, HARD_MAX = 800, 150, 1600, 16_000


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``text`` cleaned, in one pass. Only texts with characters beyond ASCII or carriage returns go to Python, of
    the others only nulls; null stays null."""
    c = F.col(text)
    beyond = F.coalesce((F.octet_length(c) > F.length(c)) | c.contains("\r"), F.lit(False))
    composed = df.withColumn("__composed", T.compose(F.when(beyond, c)))
    return composed.withColumn(text, T.clean(F.coalesce("__composed", c))).drop("__composed")


def paragraphs(df: DataFrame, text: str = "text") -> DataFrame:
    """One row for each paragraph that is not blank: (other columns, chunk_no, chunk). Numbers count the blank ones too."""
    rest = [F.col(c) for c in df.columns if c != text]
    parts = df.select(*rest, F.posexplode(F.split(F.col(text), r"\n{2,}")).alias("chunk_no", "chunk"))
    return parts.withColumn("chunk", T.strip(F.col("chunk"))).filter("chunk <> ''")


# --- split_text ----------------------------------------------------------------------------------------------------------------


def split_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of about ``size`` characters at the strongest separators that occur, the next beginning with whole pieces of the
    last, ``overlap`` characters at most. Words are never cut; a separator stays in front of what follows it."""
    if text is None or not text.strip():
        return []
    if len(text) <= size:
        return [text.strip()]
    return [s for c in _cut(text, size, overlap, tuple(separators)) if (s := c.strip())]


def _cut(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> list[str]:
    if len(text) <= size:
        return [text]
    for at, separator in enumerate(separators):
        head, *tail = text.split(separator)
        pieces = [p for p in (head, *(separator + t for t in tail)) if p]
        if len(pieces) > 1:
            return [c for group in _pack(pieces, size, overlap) for c in (_cut(group, size, overlap, separators[at + 1 :]) if len(group) > size else [group])]
    return [text]


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    out: list[str] = []
    held: list[str] = []
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            whole = "".join(held)
            if whole.strip():
                out.append(whole)
            kept, room = 0, overlap
            while kept < len(held) and len(held[-1 - kept]) <= room:
                room -= len(held[-1 - kept])
                kept += 1
            held = held[len(held) - kept :]
            length = overlap - room
        held.append(piece)
        length += len(piece)
    whole = "".join(held)
    return [*out, whole] if whole.strip() else out


def enforce_hard_max(chunks: list[str], most: int = HARD_MAX) -> list[str]:
    """Chunks beyond ``most`` characters are split again; blank ones go."""
    if most <= 0:
        raise ValueError("most must be positive")
    return [s for c in chunks for s in ([c.strip()] if len(c) <= most else split_text(c, most, max(1, most // 20))) if s]


_RULE = re.compile(r"^\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?$")


def split_table(text: str | None, size: int = TABLE_SIZE, most: int = HARD_MAX) -> list[str]:
    """Groups of rows of a table, each with its header (two lines if the second is a rule of two columns or more)."""
    if text is None or not text.strip():
        return []
    if len(text) <= size:
        return [text.strip()]
    lines = text.strip().splitlines()
    if len(lines) <= 1:
        return enforce_hard_max([text], most)
    top = 2 if _RULE.match(lines[1].strip()) else 1
    header = "\n".join(lines[:top])
    room = size - len(header) - 1
    if room <= 0:
        return enforce_hard_max([text], most)
    groups: list[list[str]] = []
    left = 0
    for row in lines[top:]:
        cost = len(row) + 1
        if not groups or cost > left:
            groups.append([])
            left = room
        groups[-1].append(row)
        left -= cost
    return enforce_hard_max(["\n".join([header, *g]) for g in groups], most)


def _series(function, *args) -> callable:
    @pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: function(s, *args))

    return run


def text_chunks(c: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> Column:
    return _series(split_text, size, overlap)(c)


def table_chunks(c: Column, size: int = TABLE_SIZE) -> Column:
    return _series(split_table, size)(c)


def chunks(df: DataFrame, text: str = "text", type_column: str = "type") -> DataFrame:
    """One row for each chunk of a block: (other columns, chunk_no, chunk).

    Texts and lists beyond 800 characters and tables beyond 1,600 are split, other blocks only beyond 16,000. Short blocks,
    nearly all, never leave the JVM. Null and blank texts have no chunks.
    """
    c, kind = F.col(text), F.coalesce(F.col(type_column), F.lit("text"))
    limit = F.when(kind.isin("text", "list"), CHUNK_SIZE).when(kind == "table", TABLE_SIZE).otherwise(HARD_MAX)
    rest = [x for x in df.columns if x != text]
    long = F.length(c) > limit

    @pandas_udf("array<string>")
    def split(texts: pd.Series, kinds: pd.Series) -> pd.Series:
        by = {"text": split_text, "list": split_text, "table": split_table}
        return pd.Series([None if t is None else enforce_hard_max(by.get(k, lambda t: [t])(t)) for t, k in zip(texts, kinds, strict=True)])

    # One pass: of short blocks only nulls go to Python.
    made = df.withColumn("__split", split(F.when(long, c), kind))
    own = F.when(long, F.col("__split")).otherwise(F.filter(F.array(T.strip(c)), lambda x: x != ""))
    return made.select(*rest, F.posexplode(own).alias("chunk_no", "chunk"))


def split_at(c: Column, separator: str, size: int) -> Column:
    """One level of splitting in the JVM: pieces with the separator in front, packed greedily without overlap."""
    parts = F.split(c, re.escape(separator))
    pieces = F.filter(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(separator), x))), lambda x: x != "")
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(s: Column, p: Column) -> Column:
        full = (s.cur != "") & (F.length(s.cur) + F.length(p) > size)
        return F.struct(F.when(full, F.concat(s.out, F.array(s.cur))).otherwise(s.out).alias("out"), F.when(full, p).otherwise(F.concat(s.cur, p)).alias("cur"))

    packed = F.aggregate(pieces, empty, step)
    return F.filter(F.transform(F.concat(packed.out, F.array(packed.cur)), T.strip), lambda x: x != "")
