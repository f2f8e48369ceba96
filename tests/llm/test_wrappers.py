"""Alignment decides what is markup and what is template."""

import random

import pytest

from folioforge.llm import markup as M

SCHEMA = "block_id long, paper_id string, type string, text string"


def frame(spark, texts):
    return spark.createDataFrame([(i, f"p{i % 3}", "text", t) for i, t in enumerate(texts)], SCHEMA)


def found(spark, texts, plan=None):
    return {r["block_id"]: (r["kinds"], r["clean"]) for r in M.clean_blocks(frame(spark, texts), plan).collect()}


TEXTS = ["<b>One</b> and two", "\\emph{One} and [two](a)", "= One =\ntext", "a &lt; b", "see \\zork{one} here", "see \\zork{two} there", "<blurb>one</blurb> x", "<blurb>two</blurb> y", "see C:\\rig\\new as it is", "the set <n and m> is", "plain text", "once \\qux{one} only"]


def test_names_are_learned_from_pages(spark):
    got = found(spark, TEXTS)
    assert {i: k for i, (k, _) in got.items()} == {0: ["html"], 1: ["markdown", "latex"], 2: ["wiki"], 3: ["html"], 4: ["latex"], 5: ["latex"], 6: ["html"], 7: ["html"]}
    assert got[4][1] == "see one here" and got[6][1] == "one x"


def test_without_alignment_nothing_is_found(spark, monkeypatch):
    """The ablation: with trees that match nowhere, no label varies, and every row is lost."""
    from pyspark.sql import functions as F

    real = M._aligned
    monkeypatch.setattr(M, "_aligned", lambda shapes: real(shapes).withColumn("slots", F.transform("slots", lambda s: F.lit(-1))))
    assert found(spark, TEXTS) == {}


def test_one_page_of_each_is_not_enough(spark, monkeypatch):
    """Without the general pages only what varies between pages of the corpus itself is markup."""
    monkeypatch.setattr(M, "general_pages", list)
    assert set(found(spark, TEXTS)) == {4, 5, 6, 7}


def test_labels_are_joined_alike(spark):
    assert found(spark, TEXTS, M.MarkupPlan(most_labels=0, most_shapes=0)) == found(spark, TEXTS)


def test_copies_are_no_template(spark):
    rows = [(i, "h", "text", "<div><p>The same page</p></div>") for i in range(30)]
    assert {r["clean"] for r in M.clean_blocks(spark.createDataFrame(rows, SCHEMA)).collect()} == {"The same page"}


@pytest.mark.parametrize("n", [10, 700])
def test_template_of_large_trees(spark, n):
    """Template is found in trees of any size."""
    rows = [(i, "h", "text", "<div><p>Site notice</p></div>" + "".join(f"<p>Line {i * n + j}</p>" for j in range(n))) for i in range(10)]
    got = {r["block_id"]: r["clean"] for r in M.clean_blocks(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 10 and all("Site notice" not in c and f"Line {i * n}" in c and f"Line {i * n + n - 1}" in c for i, c in got.items())


def test_pieces_hold_every_node_once():
    rng = random.Random(2)

    def tree(depth):
        return M.Node(rng.choice("ab"), children=[tree(depth - 1) for _ in range(rng.randint(0, 4) if depth else 0)])

    for _ in range(60):
        root = M.Node("root", children=[tree(4) for _ in range(rng.randint(1, 6))])
        nodes = sum(1 for _ in M.walk(root))
        cut = M.pieces(root, 12)
        assert sorted(i for _, own in cut for i in own) == list(range(nodes)) and all(len(own) <= 12 for _, own in cut)


def test_deep_and_long():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    root = M.read_tree(deep)
    assert M.markup_kinds(root) == ["html"] and M.write(root) == "x"
    assert M.write(M.read_tree("<p>a</p> " * 5000)).count("a") == 5000
    for text in ("<" * 3000, "*" * 3000, "[" * 3000, "$" * 3001, "{{" * 3000, "\\" * 3000, "_" * 3000):
        M.write(M.read_tree(text))
