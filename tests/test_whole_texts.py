"""Queries over whole texts, on texts that hold what the operators look for."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from folioforge.plans import reference_queries as Q

LONG = "Lorem ipsum. " * 2000
TEXTS = [
    LONG + "R E S U L T S\nx" + LONG + "<document>y</document>",
    "A B C D.",
    "A B C D1E F G H and xA B C D E F G H-",
    "a\nb c\td e. I am A B C D EF, é B C D E é",
    "</document></document> <document><DOCUMENT>",
    "",
    None,
]
EXPECTED = {
    "q_spaced_documents": [
        LONG + "RESULTS\nx" + LONG + "<document>y</document>",
        "ABCD.",
        "ABCD1EFGH and xA BCDEFGH-",
        "a\nbc\tde. I am ABC D EF, é BCDE é",
        "</document></document> <document><DOCUMENT>",
        "",
        None,
    ],
    "q_wrap_documents": [t if t is None else t.replace("<document>", "<document_lit>").replace("</document>", "</document_lit>") for t in TEXTS],
}
APPENDED = {"q_spaced_documents": ("", " A; METHODS; and a b c"), "q_wrap_documents": ("<document>\n", "</document_lit> x <DOCUMENT> <document_lit>\n</document>")}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    pq.write_table(pa.table({"doc_id": pa.array(range(len(TEXTS)), pa.int64()), "text": pa.array(TEXTS, pa.string())}), at / "documents.parquet")
    return str(at)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_whole_documents(spark, folder, name):
    before, behind = APPENDED[name]
    expected = [None if t is None else before + t + behind for t in EXPECTED[name]]
    got = [r[1] for r in sorted(Q.queries()[name](spark, folder).collect())]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    sql = [r[1] for r in sorted(duck.execute(Q.oracle_sql()[name]).fetchall())]
    assert got == expected
    assert sql == expected


def test_prompts_keep_what_the_limit_allows(spark, tmp_path):
    abstracts = ["x" * 430, "é" * 2000, "y" * 2001, "", None]
    papers = {"bundle_id": pa.array(range(5), pa.int64()), "title": ["T"] * 5, "journal": ["J", "", None, "J", "J"], "abstract": pa.array(abstracts, pa.string())}
    pq.write_table(pa.table(papers), tmp_path / "papers.parquet")
    expected = ["Title: T\nPrevious: J\n" + "x" * 430, "Title: T\n" + "é" * 2000, "Title: T\n" + "y" * 2000, "Title: T\nPrevious: J\n", "Title: T\nPrevious: J"]
    assert [r[1] for r in sorted(Q.queries()["q_prompts_whole"](spark, str(tmp_path)).collect())] == expected
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW papers AS SELECT * FROM '{tmp_path}/papers.parquet'")
    assert [r[1] for r in sorted(duck.execute(Q.oracle_sql()["q_prompts_whole"]).fetchall())] == expected
