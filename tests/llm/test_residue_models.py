"""The models of residue know no case of the test tables by heart, and find forms they never saw."""

import os
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from folioforge.llm import residue as R

DATA = os.environ.get("FOLIOFORGE_TESTDATA", "/root/testdata/sf0.001").rsplit("/", 1)[0] + "/sf0.1"

FRESH = [
    "Oh no! There is nothing here. Try the start page or the search box.",
    "Our systems are being upgraded tonight. Come back tomorrow.",
    "Turn off your content filter to continue to the site.",
    "Deze pagina is niet gevonden. Ga terug naar de startpagina.",
    "Access to this document is restricted. Ask your librarian for a licence.",
    "Your session timed out. Sign in again to continue reading.",
    "This site needs JavaScript in order to show the article. Switch it on in your settings and reload.",
    "Error 500: the server could not complete the request. Please retry later.",
    "Please wait while we make sure that you are not a robot.",
    "Cookies are blocked by your browser. Allow them and reload this page.",
    "Traceback (most recent call last):\n  File \"run.py\", line 3, in <module>\nValueError: bad value",
    "Placeholder copy for the finished article. Swap this paragraph for your own words before you publish.",
    "Insert the abstract of your paper here. List up to five keywords here.",
    "Quis autem vel eum iure reprehenderit qui in ea voluptate velit esse quam nihil molestiae consequatur.",
    "Hier kommt später der eigentliche Text hin. Dieser Blindtext dient nur dem Layout.",
    "dummy text dummy text dummy text dummy text dummy text",
]
SOUND = [
    "The storage ring was cooled with helium before each run. Losses stayed below two watts over the whole night.",
    "Participants read a short story and answered ten questions about its ending. Older readers answered faster.",
    "Der Versuch wurde im Herbst auf drei Feldern wiederholt. Die Erträge lagen über denen des Vorjahres.",
    "Les élèves ont mesuré la hauteur de chaque plante pendant six semaines. La croissance était régulière.",
    "Our crawler met a missing page in two of every hundred requests. We repeated each of them after a day.",
    "El puente se construyó con piedra de la zona. Las crecidas del río lo dañaron dos veces.",
]
HOLES = ["Dear {{ first_name }}, your manuscript has arrived.", "The trial began on [START DATE] in four clinics.", "Correspondence to <email address> please.", "Yield rose by %s percent in June.", "Published in ${journal_title}, volume ${volume}.", "Approved by TODO: name of the board."]
MEANT = ["The first estimate was far too high… Template engines replace a mark such as {{ first_name }} before the page is rendered.", "The template engine replaces the variable {{ first_name }} before the page is rendered.", "The tag <address> opens an element in the language.", "In the shell script the variable ${volume} holds the path of the file.", "Let A[i] denote the element of the set {a, b, c} at place i.", "The DNA was cut as in [12] and [13, 14]."]


@pytest.fixture(scope="module")
def models():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    texts = [t for t in pq.read_table(f"{DATA}/documents.parquet", columns=["text"])["text"].to_pylist() if t and t.strip()]
    return R.fit(texts[:: max(1, len(texts) // 3000)], R.ResiduePlan())


def test_no_example_comes_from_the_tables():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    texts = "\n".join(t for t in pq.read_table(f"{DATA}/documents.parquet", columns=["text"])["text"].to_pylist() if t)
    examples = [x.strip() for s in (R.FILLER, R.NOTICES, R.ABOUT) for line in s.strip().split("\n") for x in re.split(r"(?<=[.?!])\s+", line)]
    assert [x for x in examples if len(x) >= 15 and x in texts] == []


def test_forms_never_seen(models):
    plan = R.ResiduePlan()
    found = R.residue_shares(FRESH, models, plan) >= plan.coverage
    assert found.mean() >= 0.85, [t for t, f in zip(FRESH, found, strict=True) if not f]
    # Of sound texts far from the subject of the sample, the one on missing pages is a borderline case.
    assert (R.residue_shares(SOUND, models, plan) >= plan.coverage).sum() <= 1


def test_fields_never_seen(models):
    plan = R.ResiduePlan()
    found = R.placeholder_rows(HOLES, models, plan)
    assert found.all(), [t for t, f in zip(HOLES, found, strict=True) if not f]
    meant = R.placeholder_rows([*MEANT, *SOUND], models, plan)
    assert not meant.any(), [t for t, f in zip([*MEANT, *SOUND], meant, strict=True) if f]


def test_one_pass_equals_one_by_one(models):
    plan = R.ResiduePlan()
    texts = [*FRESH, *SOUND, "", " ", "x", "A title\n\n" + FRESH[0], "a" * 5000]
    together = R.residue_shares(texts, models, plan)
    assert [round(x, 9) for x in together] == [round(float(R.residue_shares([t], models, plan)[0]), 9) for t in texts]


def test_slices_of_long_texts(models, monkeypatch):
    """A text that is scored in slices has the share of the whole."""
    plan = R.ResiduePlan()
    text = "A title\n\n" + "\n".join((FRESH + SOUND) * 20)
    whole = R.residue_shares([text, FRESH[0]], models, plan)
    monkeypatch.setattr(R, "_SLICE", 700)
    assert len(list(R._slices([text]))) > 10
    assert np.allclose(R.residue_shares([text, FRESH[0]], models, plan), whole)
