"""What is joined to the papers has a row for every paper."""

import os

import pytest

from folioforge.plans import reference_queries as Q

DATA = os.environ.get("FOLIOFORGE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize(("name", "operator", "left", "right"), [("q_ingest_results", "ingest_results", 0, 2), ("q_tag_updates", "tag_updates", 0, 1)])
def test_joined_table_is_whole(spark, monkeypatch, name, operator, left, right):
    real, sizes = getattr(Q.P, operator), []
    monkeypatch.setattr(Q.P, operator, lambda *t: sizes.append((t[left].count(), t[right].count())) or real(*t))
    Q.queries()[name](spark, DATA)
    assert sizes[0][0] == sizes[0][1] > 0
