"""A word wholly in look-alike letters is found also where nothing else in the text is odd."""

from folioforge.llm import unicode_form as U


def test_word_of_doubles_alone(spark):
    words = ["ѕсоре", "һоре", "соԁе", "ԛоре", "ԝаре", "соԍе", "сӏаѕѕ", "ӏоре"]
    texts = [f"We measured the {w} of the sample twice." for w in words]
    assert all(any(c in t for t in texts) for c in "ѕһԁԛԝԍӏ")
    records = spark.createDataFrame([("block", i, t) for i, t in enumerate(texts)] + [("block", 99, "Plain text, and мир.")], "record_kind string, record_id long, text string")
    got = {r["record_id"]: r["canonical"] for r in U.canonical_texts(records, {}).collect()}
    assert got == {i: U.canonical(t) for i, t in enumerate(texts)}
    assert got[0] == "We measured the scope of the sample twice." and all(t.isascii() for t in got.values())
