"""Names and vectors against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import knn as K
from folioforge.llm import segment_join as J
from folioforge.llm.names import link_names, name_pairs, read_name
from folioforge.llm.segment_join import index_entries, probe_entries, similar_pairs, within


def distance(a, b):
    d = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i, j] = i + j
                continue
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


words = st.text(alphabet="abc", min_size=1, max_size=9)


@settings(max_examples=400, deadline=None)
@given(words, words, st.integers(1, 2))
def test_distance_and_index(a, b, k):
    near = distance(a, b) <= k
    assert within(a, b, k) is near
    if near and a != b:
        meet = {*index_entries(a, k)} & {*probe_entries(b, k)} or {*index_entries(b, k)} & {*probe_entries(a, k)}
        assert meet


def test_similar_pairs(spark):
    rng = np.random.default_rng(0)
    strings = sorted({"".join(rng.choice(list("abcd"), rng.integers(4, 8))) for _ in range(150)})
    df = spark.createDataFrame([("x", s) for s in strings] + [("y", strings[0]), (None, "a"), ("x", None), ("x", strings[1])], "block string, s string")
    got = {(r["a"], r["b"]) for r in similar_pairs(df).collect()}
    assert got == {(a, b) for a in strings for b in strings if a < b and distance(a, b) <= 1}


@pytest.mark.parametrize(
    ("name", "head", "rest", "how"),
    [("Dr. Jane Doe, PhD", "doe", "jane", "full"), ("Doe, J.", "doe", "j", "initial"), ("and Jürgen M. DOE2,5", "doe", "jurgen", "full"), ("Doe OK", "doe", "o", "initial"), ("JaneDoe", "doe", "jane", "full"), ("Wilh. Doe", "doe", "wilh", "cut"), ("Bob Doe", "doe", "robert", "full"),
     ("The Foo Laboratory of Slow Hydrology (LSH)", "foo", "laboratory slow hydrology", "full"), ("Slow Hydrology Institute, Foo", "foo", "institute slow hydrology", "full"), ("Obs. Tid. Acoust., Foo", "foo", "observatory tid. acoust.", "cut"), ("Foo CTA", "foo", "cta", "acronym")],
)
def test_forms(name, head, rest, how):
    form = read_name(name)
    assert (form["head"], form["rest"], form["how"]) == (head, rest, how)


def test_nobody():
    assert all(read_name(x) is None for x in (None, "", " ", "et al.", "Anonymous", "12", "--"))


def test_links(spark):
    same = [
        ["Victoria Kyhydymi", "victoria KYHYDYMI", "Kyhydymi, Vicky", "Victorai Kyhydymi", "Dr. Victoria Kyhydymi", "V. Kyhydymi", "Kyhydymi Victoria", "Vict. Kyhydymi", "V. Kyhdymi"],
        ["Foomuk Laboratory of Slow Hydrology", "Laboratory of Slow Hydrology, Foomuk", "Foomuk Lab. Slow Hydrol.", "Foomuk LSH", "Foomuk Slow Hydrology Laboratory", "Foomuk Laboratory of SlowHydrology"],
        ["Barzuk Laboratory of Slow Hydrology"],
        ["Victoria Bonelute"],
        ["Oskar Kyhydymi"],
        ["Uliana Pasopifi", "Pasopifi, Uliana"],
        ["Ulrich Pasopifi"],
        ["U. Pasopifi"],  # may be either
    ]
    names = [n for g in same for n in g] + [None, "", "et al.", "Victoria Kyhydymi"]
    linked = link_names(spark.createDataFrame([(n,) for n in names], "name string"))
    got = {(r["name_a"], r["name_b"]) for r in name_pairs(linked).collect()}
    assert got == {(a, b) for g in same for a in g for b in g if a < b}


def test_short_forms_are_mined(spark):
    """A given name that stands beside another one under surnames of one person is its short form; a name of its own is none."""
    from folioforge.llm.names import short_forms

    people = [(f"rare{i}", g) for i in range(6) for g in ("wolodymyr", "wolko")] + [(f"other{i}", "wolodymyr") for i in range(4)]
    # Persons of one surname: every pair of given names is met once.
    people += [(f"mixed{i}{j}", g) for i, a in enumerate(("anatol", "ines", "stella")) for j, b in enumerate(("boris", "carl", "dora")) for g in (a, b)]
    people += [("miller", f"name{i}") for i in range(50)] + [("rare0", None), (None, "wolko")]
    got = {(r["rest"], r["meant"]) for r in short_forms(spark.createDataFrame(people, "head string, rest string")).collect()}
    assert got == {("wolko", "wolodymyr")}
    assert short_forms(spark.createDataFrame([], "head string, rest string")).count() == 0


def test_an_error_in_each_part(spark):
    """Two typing errors, one in each part, link a name seen once to one that is well attested, and no two seldom names."""
    often = ["Victoria Kyhydymi", "Kyhydymi, Victoria", "Dr. Victoria Kyhydymi", "victoria kyhydymi", "VICTORIA KYHYDYMI"]
    names = [*often, "Victorya Kyhydimi", "Oskar Pasopifi", "Oscar Pasopyfi"]
    got = {(r["name_a"], r["name_b"]) for r in name_pairs(link_names(spark.createDataFrame([(n,) for n in names], "name string"))).collect()}
    same = [*often, "Victorya Kyhydimi"]
    assert got == {(a, b) for a in same for b in same if a < b}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", min_size=2, max_size=8), st.text(alphabet="abc", min_size=2, max_size=8))
def test_halves(a, b):
    """One insertion, deletion or substitution leaves a segment that both strings have in the index."""
    plain = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            plain[i, j] = i + j if not i or not j else min(plain[i - 1, j] + 1, plain[i, j - 1] + 1, plain[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
    if plain[len(a), len(b)] <= 1:
        assert {*J._half_index(a)} & {*J._half_probes(b)}


def test_no_names(spark):
    assert link_names(spark.createDataFrame([], "name string")).count() == 0


def clusters(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10 + 1, dim))
    return (centres[rng.integers(0, len(centres), n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)


def test_knn(spark):
    x = clusters(1500, 16, 1)
    x[700:760] = x[5]  # a hot vector
    x[800] = 3 * x[801]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 16), (9003, [1.0] * 15), (9004, [float("nan")] + [1.0] * 15)]
    plan = K.KnnPlan(k=5, dim=16, partition_rows=150, sample_rows=600, block_rows=64)
    found = {r["id"]: [n["id"] for n in r["neighbours"]] for r in K.nearest(spark.createDataFrame(rows, "id long, vector array<float>"), plan).collect()}
    assert set(found) == set(range(1500))
    exact = K.brute_force(np.arange(1500), x, 5).groupby("id")["other"].apply(list)
    recall = np.mean([len(set(found[i]) & set(exact[i])) / 5 for i in range(1500)])
    assert recall > 0.95
    assert found[720] == exact[720] == [5, 700, 701, 702, 703]


def test_knn_tree(spark):
    """Two levels, broadcast or joined, give the same neighbours, and nearly those of one level."""
    x = clusters(3000, 16, 2)
    x[100:150] = x[7]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<float>")
    exact = K.brute_force(np.arange(3000), x, 5).groupby("id")["other"].apply(list)
    answers = []
    for most in (65_536, 4):
        plan = K.KnnPlan(k=5, dim=16, partition_rows=100, sample_rows=1000, fan_out=8, block_rows=64, most_leaves=most)
        assert len(K._levels(3000, plan)) == 2
        answers.append({r["id"]: [n["id"] for n in r["neighbours"]] for r in K.nearest(df, plan).collect()})
    assert answers[0] == answers[1] and set(answers[0]) == set(range(3000))
    assert np.mean([len(set(answers[0][i]) & set(exact[i])) / 5 for i in range(3000)]) > 0.95


@pytest.mark.parametrize("n", [0, 1, 999, 512_000, 512_001, 10**6, 10**9, 10**12])
def test_partitions_do_not_grow(n):
    plan = K.KnnPlan()
    levels = K._levels(n, plan)
    assert levels[-1] == plan.partition_rows and all(a <= plan.fan_out * b for a, b in zip(levels, levels[1:], strict=False))
    assert levels[0] * plan.fan_out >= n


def test_knn_small(spark):
    plan = K.KnnPlan(dim=2)
    empty = spark.createDataFrame([], "id long, vector array<float>")
    assert K.nearest(empty, plan).count() == K.neighbour_pairs(empty, plan).count() == 0
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vector array<float>")
    assert K.neighbour_pairs(one, plan).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "y")], "id long, vector array<float>, routes string")
    assert [(r["a"], r["b"]) for r in K.neighbour_pairs(two, plan).collect()] == [(1, 2)]
