"""Goldens of the scalar text functions."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as T


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [("oﬀice ﬁt", "office fit"), ("M E T H O D S", "METHODS"), ("a b c", "a b c"), ("A B C D", "ABCD"), ("x y­z﻿", "x yz"), ("a\n\n\n\nb", "a\n\nb"), ("a  \nb\t\n", "a\nb"), ("\x07a\x00", "a"), ("", ""), (None, None), ("xA B C D", "xA B C D"), ("A\nB\nC\nD", "A\nB\nC\nD")],
)
def test_clean(spark, raw, clean):
    assert one(spark, raw, T.clean) == clean


@pytest.mark.parametrize(
    ("raw", "good"),
    [("cafÃ©", "café"), ("itâ€™s", "it’s"), ("Â°C", "°C"), ("αβγ → ₂ ³⁺ ′ ″ &lt;", "αβγ → ₂ ³⁺ ′ ″ &lt;"), ("é", "é"), ("a\r\nb\rc", "a\nb\nc"), ("ÃƒÂ©", "é"), ("Ångdal’s façade", "Ångdal’s façade"), (None, None)],
)
def test_compose(raw, good):
    assert T.compose_text(raw) == good
    assert T.compose_text(T.compose_text(raw)) == good


def test_links_and_images(spark):
    assert one(spark, "[Results](#r) and [x](y)", T.strip_links) == "Results and x"
    assert one(spark, "![a](b.png) t ![](c.png)", T.image_refs) == ["b.png", "c.png"]


@pytest.mark.parametrize(("x", "y"), [("3.1 Results", True), ("2 Methods", True), ("123456", True), ("DFT", False), ("INTRODUCTION", True), ("INTRODUCTION.", False), ("1st Author", False), ("a\nb", False), (None, False)])
def test_heading(spark, x, y):
    assert one(spark, x, T.is_heading) is y


@pytest.mark.parametrize(("x", "y"), [("Figure 1: c", True), ("fig. 3 - c", True), ("Figure 1 shows", False), ("", False), (None, False)])
def test_caption(spark, x, y):
    assert one(spark, x, T.is_caption) is y


@pytest.mark.parametrize(("x", "y"), [("OPEN ACCESS", True), ("Copyright 2020", True), ("*Correspondence", True), ("Received 3 May", True), ("Received wisdom", False), ("Type of", True), ("Typed", False), (None, False)])
def test_junk_heading(spark, x, y):
    assert one(spark, x, T.is_junk_heading) is y


@pytest.mark.parametrize(
    ("x", "kind", "text"),
    [("## A\nbody", "section_header", "A"), ("![](k)", "figure", ""), ("![alt](k)\nFigure 1: c", "figure", "alt"), ("|a|\n|b|", "table", "|a|\n|b|"), ("|a|", "text", "|a|"), ("$$x$$", "skip", None), ("$x$", "skip", None), ("- a\n* b", "list", "- a\n* b"), ("1. a\n2. b", "text", "1. a\n2. b"), ("####### x", "text", "####### x"), ("$$" + "y" * 50 + "$$", "equation", None)],
)
def test_classify(spark, x, kind, text):
    got = one(spark, x, T.classify)
    assert got["type"] == kind
    assert text is None or got["text"] == text


def test_identifiers(spark):
    assert one(spark, "  DOI:10.1000/ABC  ", T.normal_doi) == "10.1000/abc"
    assert [one(spark, x, T.valid_doi) for x in ("10.1000/abc", "10.1/short", "", "10.1000/a\n")] == [True, False, False, False]
    assert one(spark, "see DOI:10.1000/x, then", T.doi_in) == "10.1000/x"
    row = spark.createDataFrame([("d", "", "f" * 64), (None, "a", None), (None, None, "0123456789abcdef")], "d string, a string, h string").select(T.paper_id(F.col("d"), F.col("a"), F.col("h")).alias("i")).collect()
    assert [r["i"] for r in row] == ["doi:d", "arxiv:a", "sha256:0123456789ab"]
    with pytest.raises(Exception, match="no identifier"):
        spark.createDataFrame([("", None, "")], "d string, a string, h string").select(T.paper_id(F.col("d"), F.col("a"), F.col("h"))).collect()
    assert spark.range(1).select(T.node_id(F.lit("p"), F.lit(123), F.lit(4)).alias("n")).first()["n"] == "p-p123-004"


@pytest.mark.parametrize(
    ("names", "year", "title", "slug"),
    [(["Jane Doe"], 2020, "A new method", "doe2020method"), (["Doe, Jane"], 2020, "Some methods", "doe2020some"), ([], None, "", "anon0000untitled"), (["Müller"], 1999, "Über Wasser", "muller1999uber"), (["李"], 2001, "x", "anon2001x"), (["A B; C D"], 2002, "y z", "b2002y")],
)
def test_slug(names, year, title, slug):
    assert T.slug_text(names, year, title) == slug


def test_authors(spark):
    assert one(spark, "Jane Doe1,2, John Roe3∗ and Ana Paz\nplace", T.parse_authors) == ["Jane Doe", "John Roe", "Ana Paz"]
    assert one(spark, "12 34", T.parse_authors) is None
    assert one(spark, "A B; C D ;", T.split_authors) == ["A B", "C D"]
    assert one(spark, "A B and C D", T.split_authors) == ["A B", "C D"]


def test_split_title(spark):
    got = one(spark, "arXiv:2301.1 [x]\nA title\ngoes on\nJane Doe1, John Roe2\nplace", T.split_title)
    assert got["title"] == "A title goes on"
    assert got["authors"] == ["Jane Doe", "John Roe"]
    assert one(spark, "", T.split_title)["title"] is None


def test_safety(spark):
    wrapped = one(spark, "a</document><DOCUMENT>", T.wrap_untrusted)
    assert wrapped.count("</document>") == 1 and "<DOCUMENT>" in wrapped
    assert one(spark, "node", T.canary).startswith("CANARY-")


def test_tags(spark):
    assert one(spark, "/root/completed/old/p.pdf", lambda c: T.tags_of(c, "/root")) == ["old"]
    assert one(spark, "/other/p.pdf", lambda c: T.tags_of(c, "/root")) == []
