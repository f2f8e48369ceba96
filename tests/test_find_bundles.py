"""Bundles of files: the same rows as by comparing all pairs, and no table sent to the driver."""

import os
import random
import re

import pytest

from folioforge.operators import resolve as R
from folioforge.plans import reference_queries as Q

DATA = os.environ.get("FOLIOFORGE_TESTDATA", "/root/testdata/sf0.001")


def _parts(path):
    return re.sub("/[^/]*$", "", path), re.sub(r"\.[^.]*$", "", path.rsplit("/", 1)[-1])


def _all_pairs(files, bundles):
    for path in files:
        folder, stem = _parts(path)
        above, found = _parts(folder)[0] if "/" in folder else folder, []
        for bundle in bundles:
            there, other = _parts(bundle)
            if stem and other and there in (folder, above) and (stem in other or other in stem):
                found.append((there != folder or stem != other, there != folder, bundle))
        yield path, min(found)[2] if found else None


@pytest.mark.parametrize(("letters", "longest"), [("ab", 6), ("ab", 40), ("aé😀.", 12), ("a", 300)])
def test_rows_of_all_pairs(spark, letters, longest):
    draw = random.Random(5)
    word = lambda most: "".join(draw.choice(letters) for _ in range(draw.randint(0, most)))
    names = [word(longest) for _ in range(30)]

    def path(end):
        stem = draw.choice(names) if draw.random() < 0.5 else word(6) + draw.choice(names) + word(6)
        start = draw.randrange(len(stem) + 1) if draw.random() < 0.3 else 0
        return draw.choice(["", "/r", "a", "a/b", "a/b/c", "a/b/d"]) + "/" + stem[start:] + end

    files = [path(".pdf") for _ in range(120)] + ["", "x.pdf", "a/", "a/.pdf"]
    files, bundles = files + files[:3], [path(".bundle") for _ in range(80)] + ["", "x", "a/b/"]
    got = R.find_bundles(spark.createDataFrame([(p,) for p in files], "path string"), spark.createDataFrame([(p,) for p in bundles], "path string"))
    key = lambda r: (r[0], r[1] or "")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_all_pairs(files, bundles), key=key)


def test_shared_beginnings_form_no_pairs(spark):
    longs = spark.createDataFrame([(f"000{i:04d}_proceedings_of_the_{i:04d}",) for i in range(300)], "stem string")
    shorts = spark.createDataFrame([(f"proceedings_of_the_{i:04d}",) for i in range(300)], "stem string")
    got = R.contained(longs, shorts).collect()
    assert len(got) == 300 and all(r["stem"].endswith(r["piece"]) and len(r["piece"]) == 23 for r in got)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_lookups_are_not_broadcast(spark):
    """Many times as large as the stems they are made from, by whose size Spark would decide."""
    plan = Q.QUERIES["q_find_bundles"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
