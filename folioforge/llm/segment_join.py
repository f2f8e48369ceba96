"""Pairs of strings within a small edit distance: pigeonhole segment join.

A string is cut into segments; an edit can spoil one of them and a transposition of neighbours two, so of ``2 k + 1`` segments
one at least stays whole within ``k`` edits. The segments of all strings form an inverted index, keyed by block, length and
segment number; each string looks up its own substrings at positions shifted by up to ``k`` for the lengths within ``k``.
Candidates are verified by a banded edit distance (insertion, deletion, substitution, transposition of neighbours).

``block`` is a value that must agree as well (here: the other part of a name); it keeps frequent segments apart, so that no
index entry becomes a large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within(a: str, b: str, k: int) -> bool:
    """Whether the optimal-alignment distance of a and b is at most k; only the band of width 2 k + 1 is computed."""
    if abs(len(a) - len(b)) > k:
        return False
    if a == b:
        return True
    far = k + 1
    two: list[int] = []
    one = [j if j <= k else far for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        row = [far] * (len(b) + 1)
        if i <= k:
            row[0] = i
        for j in range(max(1, i - k), min(len(b), i + k) + 1):
            d = one[j - 1] + (a[i - 1] != b[j - 1])
            d = min(d, one[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, two[j - 2] + 1)
            row[j] = d
        if min(row) > k:
            return False
        two, one = one, row
    return one[len(b)] <= k


def cut(length: int, segments: int) -> list[tuple[int, int]]:
    """Start and length of each segment; they differ in length by one at most."""
    least, more = divmod(length, segments)
    out, at = [], 0
    for i in range(segments):
        n = least + (i >= segments - more)
        out.append((at, n))
        at += n
    return out


def index_entries(s: str, k: int) -> list[tuple[int, int, str]]:
    return [(len(s), i, s[at : at + n]) for i, (at, n) in enumerate(cut(len(s), 2 * k + 1))]


def probe_entries(s: str, k: int) -> list[tuple[int, int, str]]:
    """What ``s`` looks up; only lengths up to its own, so that a pair of different lengths is found from one side."""
    out = set()
    for length in range(max(1, len(s) - k), len(s) + 1):
        for i, (at, n) in enumerate(cut(length, 2 * k + 1)):
            for start in range(max(0, at - k), min(len(s) - n, at + k) + 1):
                out.add((length, i, s[start : start + n]))
    return sorted(out)


def _entries(df: DataFrame, k: int, make, prefix: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for block, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for length, i, part in make(s, k):
                    for column, value in zip(rows, (block, s, length, i, part), strict=True):
                        column.append(value)
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["block", prefix, "length", "segment", "part"])

    return df.mapInArrow(run, f"block string, {prefix} string, length int, segment int, part string")


def similar_pairs(strings: DataFrame, k: int = 1) -> DataFrame:
    """Distinct (block, a, b), a < b, of ``strings`` (block, s) with the same block and a distance of at most k.

    Null blocks or strings and empty strings take no part; repeated rows count once.
    """
    source = strings.select(F.col("block").cast("string").alias("block"), F.col("s").cast("string").alias("s")).filter("block is not null and s is not null and s <> ''").distinct()
    index, probes = _entries(source, k, index_entries, "t"), _entries(source, k, probe_entries, "s")
    candidates = index.join(probes, ["block", "length", "segment", "part"]).filter("s <> t").select("block", F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([within(a, b, k) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)], pa.bool_()))

    return candidates.mapInArrow(verify, "block string, a string, b string")


def halves(s: str) -> tuple[str, str]:
    """The two segments of a string that one insertion, deletion or substitution cannot both spoil."""
    return s[: len(s) // 2], s[len(s) // 2 :]


def _half_index(s: str) -> list[str]:
    a, b = halves(s)
    return [f"<{a}", f"{b}>"]


def _half_probes(s: str) -> list[str]:
    """Both segments as strings of one letter more or less would be cut: the first stays at the beginning, the second at the end."""
    out = set()
    for length in (len(s) - 1, len(s), len(s) + 1):
        n = length // 2
        out |= {f"<{s[:n]}", f"{s[len(s) - (length - n):] if length - n <= len(s) else s}>"}
    return sorted(out)


def similar_pairs_of_two(strings: DataFrame) -> DataFrame:
    """Distinct (block, a_1, a_2, b_1, b_2) of ``strings`` (block, s_1, s_2) in the same block whose first and whose second
    parts both differ, each by one edit. Two of the four segments must agree, one of each part: the key of the index."""
    source = strings.filter("block is not null and length(s_1) >= 4 and length(s_2) >= 3").select("block", "s_1", "s_2").distinct()

    def entries(make, names: tuple[str, str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows: list[tuple] = []
                for block, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    second = make(two)
                    rows += [(block, f"{x}|{y}", one, two) for x in make(one) for y in second]
                columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "part", *names])

        return source.mapInArrow(run, f"block string, part string, {names[0]} string, {names[1]} string")

    index, probes = entries(_half_index, ("t_1", "t_2")), entries(_half_probes, ("u_1", "u_2"))
    near = (F.abs(F.length("t_1") - F.length("u_1")) <= 1) & (F.abs(F.length("t_2") - F.length("u_2")) <= 1)
    met = index.join(probes, ["block", "part"]).filter((F.col("t_1") != F.col("u_1")) & (F.col("t_2") != F.col("u_2")) & near)
    a, b = F.struct(F.col("t_1").alias("x"), F.col("t_2").alias("y")), F.struct(F.col("u_1").alias("x"), F.col("u_2").alias("y"))
    pairs = met.select("block", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct().select("block", F.col("a.x").alias("a_1"), F.col("a.y").alias("a_2"), F.col("b.x").alias("b_1"), F.col("b.y").alias("b_2"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, *parts = (c.to_pylist() for c in batch.columns)
            yield batch.filter(pa.array([within(a, c, 1) and within(b, d, 1) for a, b, c, d in zip(*parts, strict=True)], pa.bool_()))

    return pairs.mapInArrow(verify, "block string, a_1 string, a_2 string, b_1 string, b_2 string")
