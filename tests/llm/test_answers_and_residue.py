import random

import numpy as np
import pytest

from folioforge.llm import pairs as P
from folioforge.llm import residue as R


def brute(potential, moves):
    """Label marginals by going through all sequences."""
    import itertools

    n, k = potential.shape
    out, z = np.zeros_like(potential), 0.0
    for ys in itertools.product(range(k), repeat=n):
        w = np.exp(sum(potential[i, y] for i, y in enumerate(ys)) + sum(moves[a, b] for a, b in zip(ys, ys[1:], strict=False)))
        z += w
        for i, y in enumerate(ys):
            out[i, y] += w
    return out / z


def test_chain_equals_brute_force():
    rng = np.random.default_rng(0)
    for n in (1, 2, 4):
        p, m = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))
        assert np.allclose(P._chain(p, m)[0], brute(p, m))


@pytest.mark.parametrize(("r", "empty"), [(None, True), ("", True), ("\u200b", True), (" \n", True), ("n/a", True), ("...", True), ("[]", True), ("Summary:", True), ("<empty>", True), ("Reef stable", False), ("5", False)])
def test_empty(r, empty):
    assert P.is_empty(r) is empty


TOPICS = ["reef", "kiln", "membrane", "glacier", "valve", "alloy", "basin", "plume"]
ENDS = ["heat transfer", "crack growth", "wave damping", "echo delay"]
MORE = ["tracer release", "neutron imaging", "laser profiling", "drone surveys", "isotope dating"]
FOREIGN = ["Die Schicht verändert die Körnung nach zwölf Stunden und nicht im Messfeld.", "Le capteur réduit la perte de chaleur pendant les mois d'été dans le bassin.", "Пористый слой замедляет перенос тепла при низкой температуре."]


def world(n, seed):
    """(block_id, text, key, value, defect) rows with known defects."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = rng.sample(TOPICS, 3)
        text = " ".join(f"The {rng.choice(['slow', 'dense', 'humid'])} {x} was measured with {rng.choice(ENDS)} in run {rng.randint(1, 99)}." for x in t)
        if rng.random() < 0.2:
            text = rng.choice(FOREIGN)
        answer = rng.choice([f"{t[0].capitalize()} not constant; depends on {t[1]} state.", f"Claim: {t[0]} enough for {rng.choice(ENDS)}", f"Unable to separate {rng.choice(ENDS)} from {rng.choice(ENDS)}; authors ask for longer {rng.choice(MORE)}", f"{t[2].capitalize()} stable."])
        kind = rng.random()
        if kind < 0.03:
            answer, defect = rng.choice([None, "", "n/a", "-"]), "empty"
        elif kind < 0.06:
            answer, defect = P.refusals(rng, TOPICS, 1)[0], "refusal"
        elif kind < 0.09:
            answer, defect = rng.choice(["", "Summary: "]) + text, "copy"
        elif kind < 0.12:
            other = rng.choice([f for f in FOREIGN if f != text])
            answer, defect = other, "language"
        elif kind < 0.15:
            whole = f"Unable to separate {rng.choice(ENDS)} from {rng.choice(ENDS)}; authors ask for longer {rng.choice(MORE)}"
            answer, defect = (whole[: rng.randint(14, len(whole) - 4)].rstrip()[:-1] + rng.choice(["", "", " of", " and", " under the", " (", " –"])), "truncated"
        else:
            defect = None
        rows.append((i, text, "llm:m", answer, defect))
    return rows


def test_defects(spark):
    rows = world(3000, 1)
    df = spark.createDataFrame([(i, t, {k: v, "rake": ""}) for i, t, k, v, _ in rows] + [(9001, None, {"llm:m": "Reef stable."}), (9002, "x", None), (9003, "x", {"rake": None}), (9004, "", {"llm:a": None})], "block_id long, text string, summaries map<string,string>")
    got = {r["block_id"]: r["defect"] for r in P.find_defects(df.selectExpr("*", "1 as n", "'x' as value"), P.PairPlan(sample_pairs=1200)).collect()}
    truth = {i: d for i, *_, d in rows if d}
    right = sum(got.get(i) == d for i, d in truth.items())
    assert right / len(truth) > 0.9
    assert sum(i not in truth for i in got if i < 9000) < 0.02 * len(rows)
    assert got.get(9004) == "empty" and 9002 not in got and 9003 not in got


def test_no_pairs(spark):
    assert P.find_defects(spark.createDataFrame([], "block_id long, text string, summaries map<string,string>")).count() == 0


# --- residue ----------------------------------------------------------------------------------------------------------------------

PROSE = ["The reef was measured in winter and the flow was small.", "Coating the kiln hid the change in echo delay.", "We found that heat transfer fell from 5 to 3 units.", "Die Schicht verändert die Körnung nach zwölf Stunden.", "The controller logs 503 errors when the pump stops, and we discuss why pages go missing.", "Readers without JavaScript saw a notice asking them to enable it."]


def documents(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(PROSE, k=rng.randint(2, 12)))) for i in range(400)]
    cases = {1000: "404 Not Found\nThe page you requested could not be found.", 1001: "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", 1002: "A title of a paper\n\nPlease enable JavaScript to view this article.", 1003: "The reef was {{ title }} measured.", 1004: "jfk dkls ghhf akd jfjsl ghfj skdl fjgh aksj dhfg", 1005: "Dear [your name], thank you for the manuscript", 1006: "Volume {0}, pages {0}", 1007: "Results: TBD [TBD]"}
    sound = {2000: None, 2001: "", 2002: " \n", 2003: "A title\n\n" + PROSE[0], 2004: "In the shell script the variable ${RATE} sets the rate.", 2005: "Template engines fill marks such as {{name}} before rendering.", 2006: "Let S = {x | x > 3} and T[i] denote the term; see [12].", 2007: PROSE[0] + " <s> </s> xxxxxxxxxxxx", 2008: "The reef"}
    return spark.createDataFrame([*rows, *cases.items(), *sound.items(), (1000, cases[1000])], "doc_id long, text string").selectExpr("*", "'x' as why"), set(cases)


def test_residue(spark):
    df, cases = documents(spark)
    got = [r["doc_id"] for r in R.find_residue(df).collect()]
    assert set(got) == cases and got.count(1000) == 2
    assert R.find_residue(df.limit(0)).count() == 0


def test_windows_cover_the_text():
    x = R._codes("One. Two is longer than one!  Three\n\nFour … five " + "x" * 300)
    starts = R.window_starts(x, 90)
    assert starts[0] == 0 and (np.diff(starts) > 0).all() and np.diff(np.append(starts, len(x))).max() <= 135
    assert R.window_starts(x[:0], 90).size == 0
