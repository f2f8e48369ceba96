"""The field of answers knows no refusal of the test tables by heart, and finds forms it never saw."""

import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from folioforge.llm import pairs as P

DATA = os.environ.get("FOLIOFORGE_TESTDATA", "/root/testdata/sf0.001").rsplit("/", 1)[0] + "/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

FRESH = [
    "I'm sorry, I can't do this one.",
    "I won't produce this, it might hurt somebody.",
    "Unfortunately there is nothing in your message that I can read.",
    "Please give me the article first, then I will shorten it.",
    "As an AI model I am not able to look at files.",
    "I would prefer not to comment on this paper.",
    "Sorry, but my instructions do not allow me to write about this.",
    "I don't think I should answer that.",
    "I was unable to find any text to work with, could you send it again?",
    "I have to say no to this request.",
]


@pytest.fixture(scope="module")
def table():
    rows = pq.read_table(f"{DATA}/blocks.parquet", columns=["text", "summaries"]).to_pylist()
    return [(r["text"], v) for r in rows for k, v in (r["summaries"] or []) if k.startswith("llm:") and v is not None]


def test_no_example_comes_from_the_tables(table):
    answers = "\n".join({v.lower() for _, v in table})
    phrases = {x.split("{")[0].strip(" .,;!?").lower() for kind in P._REFUSE.values() for x in kind}
    assert sorted(x for x in phrases if len(x) >= 20 and x in answers) == []


def test_forms_never_seen(table):
    rng = random.Random(1)
    judge = P.fit(rng.sample([(t, v) for t, v in table if t], 3000), P.PairPlan())
    text = "The slow reef was measured with echo delay in run 12. It stayed stable under a load of 5 kN."
    got = [judge.defect(text, r, (0.5, 0.0, 0.01)) for r in FRESH]
    assert np.mean([g == "refusal" for g in got]) >= 0.8, [(r, g) for r, g in zip(FRESH, got, strict=True) if g != "refusal"]


def test_chains_equal_single_ones():
    rng = np.random.default_rng(2)
    p, m = rng.normal(size=(5, 4, 3)), rng.normal(size=(3, 3))
    got, pairs = P._chains(p, m)
    one = [P._chain(x, m) for x in p]
    assert np.allclose(got, [a for a, _ in one]) and np.allclose(pairs, sum(b for _, b in one))


def test_rare_last_words_are_joined(spark):
    """Statistics of last words that are broadcast or joined give the same rows; words of any length count."""
    words = ["x" * 80 + "ab", "x" * 80 + "abc", "stable", "reef", "low"]
    rng = random.Random(3)
    rows = [(i, "The reef is low.", {"llm:m": f"Reef {rng.choice(words)} and {rng.choice(words)}"}) for i in range(300)]
    df = spark.createDataFrame(rows, "block_id long, text string, summaries map<string,string>")
    counts = {r["last"]: r["longer"] for r in P.word_endings(P.responses(df)).collect()}
    assert counts["x" * 80 + "ab"] > 0 and counts["x" * 80 + "abc"] == 0
    got = [sorted(tuple(r) for r in P.find_defects(df, P.PairPlan(most_words=n)).collect()) for n in (300_000, 2)]
    assert got[0] == got[1]


@pytest.mark.parametrize("value", [None, "Reef stable.", "I cannot help with this."])
def test_single_answers(spark, value):
    df = spark.createDataFrame([(1, "The reef is low.", {"llm:m": value})], "block_id long, text string, summaries map<string,string>")
    assert [r["defect"] for r in P.find_defects(df).collect() if value is None] == (["empty"] if value is None else [])
