from pyspark.sql import functions as F

from folioforge.operators import maintain as M
from folioforge.operators import resolve as R

HEADER = "bundle_id long, title string, year int, doi string, abstract string, journal string, s2_id string, arxiv_id string, authors array<struct<name:string>>"


def test_sidecar_states(spark):
    papers = spark.createDataFrame([(i, "O", 2000, "d", "a", "j", "x", "r", [("A",)]) for i in range(6)], HEADER)
    bodies = ['{"s2_id": null, "doi": "e", "title": "", "author": ["B", ""]}', "{broken", "", None, "[1]", '{"author": null, "year": "1999"}']
    sides = spark.createDataFrame(list(enumerate(bodies)), "bundle_id long, body string")
    got = {r["bundle_id"]: r for r in R.override(papers, sides, "bundle_id").collect()}
    assert (got[0]["title"], got[0]["s2_id"], got[0]["doi"], got[0]["author_names"]) == ("O", None, "e", ["B"])
    assert all(got[i]["title"] == "O" and got[i]["author_names"] == ["A"] for i in (1, 2, 3, 4))
    assert (got[5]["author_names"], got[5]["year"]) == ([], 1999)


def test_best_doi(spark):
    c = spark.createDataFrame([("a", 0, "10.1000/x", "filename"), ("a", 1, "doi:10.1000/Y", "bundle"), ("b", 0, "10.1000/z", "filename"), ("b", 1, "bad", "bundle"), ("c", 0, None, "bundle")], "id string, pos int, doi string, provenance string")
    known = spark.createDataFrame([("10.1000/X",)], "doi string")
    got = {r["id"]: (r["doi"], r["validated"]) for r in R.best_doi(c, known).collect()}
    assert got == {"a": ("10.1000/x", True), "b": ("10.1000/z", False)}


def test_gates(spark):
    rows = [(True, [], None, None, None, "abcd", "s"), (True, [], "d", None, None, "abcd", "anon1"), (False, ["w1", "w2"], "d", None, None, "t", "s"), (True, [], None, None, None, "A good title", "anon2"), (None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "v boolean, w array<string>, d string, a string, s string, t string, g string")
    got = [r["x"] for r in df.select(R.rejection(*[F.col(c) for c in "vwdastg"]).alias("x")).collect()]
    assert got == ["garbage title", None, "unverified: w1; w2", "anonymous", "unverified"]


def test_hashes(spark):
    df = spark.createDataFrame([("a", ["b", "a", ""], "c"), ("a", None, "a"), ("", ["x"], "x")], "o string, h array<string>, n string")
    got = df.select(M.valid_hashes(F.col("o"), F.col("h")).alias("v"), M.append_hash(F.col("o"), F.col("h"), F.col("n")).alias("r")).collect()
    assert [r["v"] for r in got] == [["a", "b"], ["a"], ["x"]]
    assert [(r["r"]["history"], r["r"]["changed"]) for r in got] == [(["b", "a", "", "c"], True), (["a"], False), (["x"], False)]


def test_rename_and_conflicts(spark):
    plan = {r["path"]: r["conflict"] for r in M.rename_plan(spark.createDataFrame([("d/a.x", "n"), ("d/b.x", "n"), ("d/c.x", "b"), ("d/e.x", "e")], "path string, new_stem string")).collect()}
    assert plan == {"d/a.x": False, "d/b.x": True, "d/c.x": True, "d/e.x": False}
    moves = spark.createDataFrame([("a/p.pdf", "done", "1"), ("b/p.pdf", "done", "1"), ("c/p.pdf", "done", "1")], "path string, folder string, stamp string")
    assert sorted(r["dest"] for r in M.conflict_names(moves).collect()) == ["done/p.pdf", "done/p_1.pdf", "done/p_1_2.pdf"]


def test_log_line_has_seven_cells(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05' t, 'u' u, null s, 'd' d, 'f' f, 3L r, 'a\tb' x")
    line = df.select(M.log_line(*[F.col(c) for c in "tusdfrx"]).alias("l")).first()["l"]
    assert line == "2024-01-02T03:04:05\tu\t\td\tf\t3\ta b"


def test_rescue(spark):
    texts = {"p": ["1. Introduction", "The real title", "Jane Doe, John Roe"], "r": ["A title that is known", "Ana Paz and Bo Lim", "Text. With. Many. Full. Stops."], "n": ["Abstract", "x"]}
    blocks = spark.createDataFrame([(k, i, i, "text", t) for k, ts in texts.items() for i, t in enumerate(ts)], "paper_id string, pos int, block_id long, type string, text string")
    heads = spark.createDataFrame([("p", "", None, None, 2000), ("q", "", None, None, None), ("r", "A title that is known", [], "10.1/r", None), ("n", None, None, None, None)], "paper_id string, title string, authors array<struct<name:string>>, doi string, year int")
    known = spark.createDataFrame([("the real TITLE", "10.1/far", 1990), ("the real TITLE", "10.1/a", 2001), ("x", "y", 1)], "title string, doi string, year int")
    got = {r["paper_id"]: r for r in R.rescue(blocks, heads, known).collect()}
    assert set(got) == {"p", "r"}
    assert (got["p"]["title"], got["p"]["authors"], got["p"]["doi"], got["p"]["year"], got["p"]["source"]) == ("the real TITLE", ["Jane Doe", "John Roe"], "10.1/a", 2001, "catalog_rescue")
    assert (got["r"]["title"], got["r"]["authors"], got["r"]["source"]) == (None, ["Ana Paz", "Bo Lim"], "text_rescue")
    assert R.rescue(blocks.limit(0), heads).count() == R.rescue(blocks, heads.limit(0)).count() == 0


def test_fix_up(spark):
    blocks = spark.createDataFrame([("p", 0, 1, "text", "The Slow River"), ("p", 1, 2, "text", "Jane Doe, John Roe")], "paper_id string, pos int, block_id long, type string, text string")
    kinds = "paper_id string, title string, authors array<struct<name:string>>, year int, doi string, slug string, verified boolean, entry_type string, sidecar_verified boolean, first_page string"
    page = "The Slow River\nJane Doe"
    heads = spark.createDataFrame([("p", "draft_07.indd", None, 2001, None, "anon2001draft", False, "article", None, page), ("q", "A sound title", [("A B",)], 2000, "10.1/q", "b2000sound", True, "article", None, page)], kinds)
    got = {r["paper_id"]: r for r in R.fix_up(heads, blocks).collect()}
    assert (got["p"]["title"], got["p"]["authors"], got["p"]["slug"], got["p"]["verified"], got["p"]["rescued"]) == ("The Slow River", ["Jane Doe", "John Roe"], "doe2001slow", True, True)
    assert (got["q"]["title"], got["q"]["slug"], got["q"]["rescued"]) == ("A sound title", "b2000sound", False)


def test_garbage_titles(spark):
    from folioforge.functions import text as T

    bad = ["paper_v2.indd", "Microsoft Word - final.doc", "ABC-12-3456R1", "Manuscript No. 1234", "Paper title", "untitled", "Insert title here", "nmat1849", "PII: S0008-6223"]
    good = ["The slow river", "Graphene in 2004", "Title matters for readers", "Word order in Latin", "", None]
    df = spark.createDataFrame([(t,) for t in bad + good], "t string")
    assert [r["g"] for r in df.select(T.is_garbage_title(F.col("t")).alias("g")).collect()] == [True] * len(bad) + [False] * len(good)


def test_doi_candidates(spark):
    files = spark.createDataFrame([("a", "s41586-020-2649-2", "doi:10.1/x", None, "see 10.1234/ab,", None), ("b", "10.1234_abc", None, None, None, "10.5555/i"), ("c", "plain", "", "", "", "bad")], "id string, stem string, identifier string, keywords string, subject string, internal string")
    got = sorted((r["id"], r["pos"], r["doi"], r["provenance"]) for r in R.doi_candidates(files).collect())
    assert got == [("a", 2, "10.1234/ab", "existing_tags"), ("a", 4, "10.1038/s41586-020-2649-2", "filename"), ("b", 3, "10.5555/i", "internal"), ("b", 4, "10.1234/abc", "filename")]
