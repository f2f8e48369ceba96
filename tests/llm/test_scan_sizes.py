"""The same misreading is found in small and large tables, and whichever way decisions reach the texts."""

import random

import pytest

from folioforge.llm import scan_noise as S


@pytest.mark.parametrize("times", [45, 90, 200])
def test_rare_right_words(spark, times):
    texts = [f"The sample of taromorph was heated, run {'abcdefghij'[i % 10]}." for i in range(times)] + ["The sample of tarornorph was heated again."]
    blocks = spark.createDataFrame([(i, f"p{i}", "text", t) for i, t in enumerate(texts)], "block_id long, paper_id string, type string, text string")
    papers = spark.createDataFrame([], "paper_id string, title string, journal string")
    got = {r["block_id"]: r[1] for r in S.repair_blocks(blocks, papers).collect()}
    assert got == {times: "The sample of taromorph was heated again."}


def test_ratio_is_kept(spark):
    texts = ["The sample of taromorph was heated." for _ in range(39)] + ["The sample of tarornorph was heated."]
    blocks = spark.createDataFrame([(i, f"p{i}", "text", t) for i, t in enumerate(texts)], "block_id long, paper_id string, type string, text string")
    papers = spark.createDataFrame([], "paper_id string, title string, journal string")
    assert S.repair_blocks(blocks, papers).count() == 0


PAPERS = "paper_id string, title string, journal string"
BLOCKS = "block_id long, paper_id string, type string, text string"


@pytest.mark.parametrize("most", [400_000, 0])
def test_broken_and_misread(spark, most):
    """A misread word that is broken over a line end is repaired like an unbroken one, with few decisions or many."""
    texts = ["the concentration of salt in the brine was low" for _ in range(200)] + ["the concen-\ntrafion of salt in the brine", "the concentrafion of salt", "the con\u00adcentrafion of salt in", "the con-\ncentrafion of salt in", "a well-\nknown result"] + ["a well-known result"] * 3
    rows = [(i, "p", "text", t) for i, t in enumerate(texts)]
    got = {r["block_id"]: r["repaired"] for r in S.repair_blocks(spark.createDataFrame(rows, BLOCKS), spark.createDataFrame([], PAPERS), S.ScanPlan(most_decisions=most)).collect()}
    assert got == {200: "the concentration of salt in the brine", 201: "the concentration of salt", 202: "the concentration of salt in", 203: "the concentration of salt in"}


def test_words_of_any_length(spark):
    """Misreadings of words of up to 80 letters meet their right word, by deletions or by segments."""
    rng = random.Random(1)
    plan = S.ScanPlan()
    for n in range(4, 80):
        right = "".join(rng.choice("abdeghkmopqstvwxz") for _ in range(n - 1)) + "m"
        for a, b in (("m", "rn"), ("o", "0"), ("d", "cl")):
            at = right.find(a, rng.randrange(n))
            at = right.find(a) if at < 0 else at
            if at >= 0:
                read = right[:at] + b + right[at + 1 :]
                assert S.misreading(right, read) < S.MISREAD_BELOW
                assert S.lookup_keys(right, plan, index=True) & S.lookup_keys(read, plan, index=False)


def test_what_is_looked_up():
    kept = {"well-known"}
    for text in ("a well-\nknown and un-\nknown w0rd", "x\u200by z", "one\n\ntwo-\n three"):
        asked = S.looked_up(text)
        for misread in ({"known": "k"}, {"unknown": "u"}, {"xy": "q"}, {"twothree": "t"}):
            if S.repair_text(text, misread, kept) != S.repair_text(text, {}, kept):
                assert misread.keys() & asked
