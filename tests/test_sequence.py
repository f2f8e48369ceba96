import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import sequence as S

SCHEMA = "paper_id string, pos int, block_id long, type string, text string, section_path string"


@pytest.fixture(autouse=True)
def small_pieces(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 3)


def rows_of(kinds, paper="p"):
    return [(paper, i, i, k, t, s) for i, (k, t, s) in enumerate(kinds)]


def test_sections_over_pieces(spark):
    kinds = [("text", "a", ""), ("section_header", "H", ""), *[("text", str(i), "") for i in range(9)], ("section_header", "I", ""), ("text", "z", "")]
    got = S.section_paths(spark.createDataFrame(rows_of(kinds) + rows_of(kinds[:1], None), SCHEMA)).orderBy("paper_id", "pos").collect()
    assert [r["path"] for r in got] == [[], [], *[["H"]] * 10, ["I"], ["I"]]


def brute_captions(blocks):
    out, i = [], 0
    while i < len(blocks):
        kind, text = blocks[i]
        if kind == "figure" and i + 1 < len(blocks) and blocks[i + 1][1].startswith("Figure 1:"):
            out.append((i, blocks[i + 1][1]))
            i += 2
        else:
            out.append((i, text))
            i += 1
    return out


def test_captions_equal_brute_force(spark):
    rng = random.Random(1)
    papers = {f"p{n}": [(rng.choice(["figure", "figure", "text"]), rng.choice(["Figure 1: c", "Figure 1: d", "x"])) for _ in range(14)] for n in range(40)}
    rows = [(p, i, i, k, t, "") for p, b in papers.items() for i, (k, t) in enumerate(b)]
    got = {}
    for r in S.captions(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["paper_id"], []).append((r["pos"], r["text"]))
    assert {p: sorted(v) for p, v in got.items()} == {p: brute_captions(b) for p, b in papers.items()}


def test_junk(spark):
    kinds = [("section_header", "Open access", "j"), ("text", "a", "j"), ("text", "b", "j"), ("text", "c", "other"), ("section_header", "Results", "r"), ("text", "d", "r")]
    got = S.mark_junk(spark.createDataFrame(rows_of(kinds), SCHEMA)).orderBy("pos").collect()
    assert [r["type"] for r in got] == ["junk", "junk", "junk", "text", "section_header", "text"]


def test_pages(spark):
    chunks = spark.createDataFrame(rows_of([("text", t, "") for t in ("a", "One", "x", "Seven", "y")]), SCHEMA)
    toc = spark.createDataFrame([("p", 0, "One", 1), ("p", 1, "Seven", 7), ("p", 2, "missing", 2), ("p", 3, None, 2)], "paper_id string, toc_pos int, title string, page_id int")
    totals = spark.createDataFrame([("p", 3)], "paper_id string, total_pages int")
    got = S.assign_pages(chunks, toc, totals).orderBy("pos").collect()
    assert [r["page_no"] for r in got] == [0, 1, 1, 2, 2]


def test_running_lines(spark):
    pages = [("d", i, ("Journal of Things\n" if i < 2 else "") + f"body {i}\nJournal of Things inside") for i in range(5)] + [("e", i, "Same line\nx") for i in range(2)] + [("d", 9, None)]
    df = spark.createDataFrame(pages, "doc string, page int, text string")
    assert [(r["doc"], r["line"]) for r in S.running_lines(df, share=0.3).filter("line = 'Journal of Things'").collect()] == [("d", "Journal of Things")]
    kept = {(r["doc"], r["page"]): r["text"] for r in S.strip_running_lines(df, share=0.3).collect()}
    assert kept["e", 0] == "Same line\nx" and "Journal of Things\n" not in kept["d", 0]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.section_paths(empty).count() == S.captions(empty).count() == S.mark_junk(empty).count() == 0
    assert S.number_rows(empty, "n", key="paper_id", order=["pos", "block_id"]).agg(F.count("*")).first()[0] == 0


def test_long_contents_are_looked_up_alike(spark):
    """Titles that come as an array or from an index give the same pages, also within words and of one letter."""
    import random

    rng = random.Random(5)
    words = ["Start", "Art", "Introduction", "Reintroduction of", "x", "Methods and results of the long trial", "The end"]
    chunks = spark.createDataFrame([("p" if i % 3 else "q", i, i, " ".join(rng.choices(words, k=4)) + ("\nArt" if i % 5 else "")) for i in range(60)] + [("p", 99, 99, None), ("r", 0, 200, "Start")], "paper_id string, pos int, block_id long, text string")
    toc = spark.createDataFrame([(p, i, rng.choice(words) + rng.choice(["", " " + rng.choice(words)]), i) for p in "pq" for i in range(30)] + [("p", 50, None, 1), ("p", 51, " ", 2)], "paper_id string, toc_pos int, title string, page_id int")
    totals = spark.createDataFrame([("p", 25), ("q", 40)], "paper_id string, total_pages int")
    got = [sorted((r["block_id"], r["page_no"]) for r in S.assign_pages(chunks, toc, totals, most_titles=n).collect()) for n in (200, 0)]
    assert got[0] == got[1] and len({p for _, p in got[0]}) > 3
