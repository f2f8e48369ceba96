"""The models of residue are fitted on every document, in sums that do not depend on how the table is stored."""

import random

import numpy as np
from pyspark.sql import functions as F

from folioforge.llm import residue as R

PROSE = ["The reef was measured in winter and the flow was small.", "Coating the kiln hid the change in echo delay.", "We found that heat transfer fell from 5 to 3 units.", "The DNA was cut as in [12] after {x | x > 3} hours."]
WEB = ["The server answered each request for a page with an error code.", "Pages that could not be found were requested again by the crawler.", "Access to the site was blocked for users without cookies.", "The browser failed to load scripts when the connection timed out.", "Visitors were asked to sign in before the document could be displayed."]


def test_prose_that_few_documents_have(spark):
    """Sound documents on a subject near that of notices, which a sample of 4,000 by the smallest hashes would leave out."""
    ids = [r["id"] for r in spark.range(5000).orderBy(F.shiftrightunsigned(F.xxhash64("id", F.lit(5)), 11)).collect()]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(PROSE if n < 4500 else WEB, k=4))) for n, i in enumerate(ids)]
    case = (9000, "404 Not Found\nThe page you requested could not be found.")
    df = spark.createDataFrame([*rows, case], "doc_id long, text string")
    assert [r["doc_id"] for r in R.find_residue(df).collect()] == [9000]


def test_sums_of_parts(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices([*PROSE, *WEB], k=6)) for _ in range(300)] + ["Lorem ipsum dolor sit amet, consectetur elit.", "Dear [your name], thank you.", "a\nb " + "x" * 400] * 3
    plan = R.ResiduePlan()
    want = R.fit(texts, plan)
    for parts in (1, 7):
        df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
        got = R._fit(R._Tabled(df), plan)
        assert got.limit == want.limit
        assert all(np.array_equal(getattr(got, k), getattr(want, k)) for k in ("ratios", "spans", "about"))


def test_counts_of_slices(monkeypatch):
    plan = R.ResiduePlan()
    texts = ["A title\n\n" + "\n".join(PROSE * 30), "short", "ends\n"]
    want = sum(R._count([t], plan) for t in texts)
    assert np.array_equal(R._count(texts, plan), want)
    monkeypatch.setattr(R, "_SLICE", 500)
    assert len(list(R._slices(texts))) > 10
    assert np.array_equal(R._count(texts, plan), want)


def test_limit_is_that_of_all_windows():
    counts = np.zeros(R._HIGHEST - R._LOWEST + 1, np.int64)
    counts[200], counts[400] = 990, 10
    assert R._limit(counts) == (R._LOWEST + 201) / 1000 + 0.5
    counts[400] += 1
    assert R._limit(counts) == (R._LOWEST + 401) / 1000 + 0.5
    assert R._limit(counts // 100) == R.MOST
