from pyspark.sql import functions as F

from folioforge.plans import pipelines as P

MARKDOWN = "# Title\n\nIntro text with *words*.\n\n![](fig.png)\n\n![shown](img/a.png)\n\nFigure 1: a caption\n\n## Open Access\n\nlicence text\n\n## 2 Methods\n\n" + "A sentence of the methods. " * 60 + "\n\n$$x$$\n\n- a\n- b"


def test_extract(spark):
    docs = spark.createDataFrame([("p", MARKDOWN), ("q", None), ("r", ""), ("s", "one")], "paper_id string, markdown string")
    toc = spark.createDataFrame([("p", 0, "Methods", 4)], "paper_id string, toc_pos int, title string, page_id int")
    totals = spark.createDataFrame([("p", 5), ("s", 3)], "paper_id string, total_pages int")
    images = spark.createDataFrame([("p", 0, "page_a.png")], "doc_id string, image_pos int, name string")
    got = P.extract_blocks(docs, toc, totals, images).orderBy("paper_id", "pos", "block_id").collect()
    p = [r for r in got if r["paper_id"] == "p"]
    kinds = [(r["type"], r["text"][:14]) for r in p]
    assert kinds[:5] == [("section_header", "Title"), ("text", "Intro text wit"), ("figure", "Figure 1: a ca"), ("junk", "Open Access"), ("junk", "licence text")]
    assert p[2]["image"] == "page_a.png"
    methods = [r for r in p if r["section_path"] == ["2 Methods"]]
    assert {r["page"] for r in methods} == {4} and len(methods) > 3 and methods[-1]["type"] == "list"
    assert [r["node_id"] for r in methods] == [f"p-p04-{i:03d}" for i in range(len(methods))]
    assert [r["text"] for r in got if r["paper_id"] == "s"] == ["one"] and {r["paper_id"] for r in got} == {"p", "s"}


def test_fallback(spark):
    pages = spark.createDataFrame([(x, i, f"Running head\n1 INTRODUCTION\n\nbody of page {i} of {x}") for x in ("p", "q") for i in range(4)], "paper_id string, page int, text string")
    good = spark.createDataFrame([("p", "# H\n\ntext", None), ("q", None, "broken")], "paper_id string, markdown string, error string")
    got = P.extract_or_fall_back(good, pages).collect()
    assert {r["text"] for r in got if r["paper_id"] == "p"} == {"H", "text"}
    assert all("Running head" not in r["text"] for r in got) and len({r["page"] for r in got if r["paper_id"] == "q"}) == 4


def test_ingest(spark):
    files = spark.createDataFrame([("a.pdf", "1"), ("b.pdf", "2"), ("c.pdf", "3"), ("d.pdf", "4")], "path string, pdf_hash string")
    head = "pdf_hash string, verified boolean, verify_warnings array<string>, doi string, arxiv_id string, s2_id string, title string, slug string"
    headers = spark.createDataFrame([("1", True, [], "10.1/a", None, None, "T", "s1"), ("2", False, ["w"], None, None, None, "T", "s2"), ("3", False, [], None, None, None, "T", "s3")], head)
    shared = spark.createDataFrame([("3", ["9", "3"], "A title", "own"), ("2", ["8"], "A title", "x")], "pdf_hash string, hashes array<string>, title string, slug string")
    got = {r["path"]: (r["status"], r["reason"], r["slug"]) for r in P.ingest_results(files, headers, shared).collect()}
    assert got == {"a.pdf": ("ok", None, "s1"), "b.pdf": ("failed", "unverified: w", "s2"), "c.pdf": ("ok", None, "own"), "d.pdf": ("failed", "no metadata", None)}


def test_meta_and_settings(spark):
    m = spark.range(1).select(P.enrichment_meta("stub", F.lit("digest"), "rake", {"a": ("m", 3), "b": ("n", 4)}, ("a",)).alias("m")).first()["m"]
    assert m["profiles"] == ["a", "b"] and list(m["embedding_models"]) == ["a"] and m["paper_summaries"] == {"rake": "digest"}
    assert P.setting({"K": "env"}, {"K": "conf"}, "K") == "env" and P.setting({}, {"K": "conf"}, "K") == "conf" and P.setting({}, {}, "K", "d") == "d"


def test_empty(spark):
    docs = spark.createDataFrame([], "paper_id string, markdown string")
    assert P.extract_blocks(docs).count() == 0
    assert P.extract_pages(spark.createDataFrame([], "paper_id string, page int, text string")).count() == 0
