"""Every query of the reference's operators against its SQL on the smallest tables."""

import math
import os
import re
import unicodedata

import duckdb
import pyarrow.parquet as pq
import pytest

from folioforge.functions import text as T
from folioforge.operators import enrich as E
from folioforge.plans import reference_queries

DATA = os.environ.get("FOLIOFORGE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else str(round(v, 6))
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(reference_queries.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = reference_queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=str)
    answer = duck.execute(reference_queries.oracle_sql()[name])
    names = [x[0] for x in answer.description]
    assert sorted(names) == columns
    assert got == sorted(([plain(r[names.index(c)]) for c in columns] for r in answer.fetchall()), key=str)


def rows(spark, name):
    return reference_queries.queries()[name](spark, DATA).collect()


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def test_every_query_is_tested():
    """What has no SQL has a test of its own below."""
    assert reference_queries.queries().keys() - reference_queries.oracle_sql().keys() == {"q_clean_full", "q_mojibake", "q_extract", "q_extract_pages", "q_enrich"}


def test_clean_full(spark):
    got = {r["block_id"]: r["text"] for r in rows(spark, "q_clean_full")}
    texts = {r["block_id"]: r["text"] for r in read("blocks")}
    assert got.keys() == texts.keys()
    for key, text in texts.items():
        if text is None:
            assert got[key] is None
            continue
        lines = [x.rstrip() for x in (T.compose_text(text) or "").split("\n")]
        assert unicodedata.is_normalized("NFC", got[key]) and got[key] == got[key].strip() and not re.search("[\ufb00-\ufb06\u00ad\u200b\x00-\x08]|\n{3}|[ \t]\n", got[key])
        if text.isascii() and not re.search(r"(?<![A-Za-z])(?:[A-Za-z]\s){3}[A-Za-z](?![A-Za-z])", text):
            assert got[key] == re.sub("\n{3,}", "\n\n", "\n".join(lines)).strip()


def test_mojibake(spark):
    got = {r["bundle_id"]: r["title"] for r in rows(spark, "q_mojibake")}
    titles = {r["bundle_id"]: r["title"] for r in read("papers") if r["title"] and not r["title"].isascii()}
    assert got == {k: T.compose_text(t) for k, t in titles.items()}


def test_extract(spark):
    got = rows(spark, "q_extract")
    texts = {str(r["doc_id"]): r["text"] for r in read("documents") if r["text"] is not None}
    by = {}
    for r in got:
        by.setdefault(r["paper_id"], []).append(r)
    assert by.keys() == texts.keys()
    for paper, blocks in by.items():
        assert len({b["node_id"] for b in blocks}) == len(blocks) and all(b["page"] <= 4 for b in blocks)
        figures = [b for b in blocks if b["type"] == "figure"]
        # The page of the figure is bounded by the last page; it took its caption and its image.
        assert [(f["text"], f["image"], f["page"]) for f in figures][-1:] == [("Fig. 1: A plot of it.", "one.png", 4)]
        # The first words of a plain text are those of its blocks.
        first = "".join(re.findall(r"[A-Za-z]+", texts[paper]))[:20]
        if texts[paper].isascii() and re.match(r"[A-Za-z]", texts[paper]):
            assert "".join(re.findall(r"[A-Za-z]+", " ".join(b["text"] for b in blocks))).startswith(first)


def test_extract_pages(spark):
    got = rows(spark, "q_extract_pages")
    pages = {(r["paper_id"], r["doc_id"]): r["text"] for r in read("documents") if r["paper_id"] is not None}
    assert got and {(r["paper_id"], r["page"]) for r in got} <= {k for k, t in pages.items() if t and t.strip()}
    for r in got:
        assert r["type"] in ("text", "section_header") and r["text"] == r["text"].strip() and r["node_id"].startswith(f"{r['paper_id']}-p{r['page']:02d}-")


def test_enrich(spark):
    got = {r["block_id"]: r for r in rows(spark, "q_enrich")}
    skipped = {"section_header", "title", "author", "equation", "junk"}
    blocks = read("blocks")
    assert got.keys() == {b["block_id"] for b in blocks}
    for b in blocks:
        text, r = (b["text"] or "").strip(), got[b["block_id"]]
        assert (r["dim"] == 8) == (b["type"] not in skipped and text != "")
        if b["type"] not in skipped and len(text) >= 50:
            assert r["said"] == E.stub_model(b["text"][:2000]) and r["rake"] == E.keywords(b["text"])
        else:
            assert r["said"] is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert e.oracle_sql().keys() <= e.queries().keys()
