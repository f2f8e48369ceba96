"""Every construct of markup, as the only one of its block, passes the filter in the JVM."""

from folioforge.llm import markup as M

ALONE = {
    "fence": ["```\nx\n```", "~~~\nx\n~~~"],
    "comment": ["a <!-- b --> c"],
    "script": ["a <script>b</script> c"],
    "pre": ["<pre>a</pre>"],
    "tag": ["a <b>b</b>", "a </p>"],
    "doctype": ["<!DOCTYPE html>"],
    "entity": ["a &amp; b", "a &#8201;b"],
    "wikitable": ["{|\n| a\n|}"],
    "template": ["a {{b|c}}"],
    "wikilink": ["a [[b]]"],
    "wikihead": ["= a =", "== a =="],
    "wikiemph": ["a ''b'' c"],
    "display": ["$$a$$", "\\[a\\]"],
    "inline": ["a $b_1$ c", "a \\(b\\) c"],
    "begin": ["\\begin{a} b"],
    "end": ["a \\end{b}"],
    "command": ["a \\emph{b}"],
    "bare": ["a \\ldots b"],
    "escape": ["a 5\\% b"],
    "mdhead": ["# a", "##\ta"],
    "setext": ["a\n===", "a\n---", "a\n--- "],
    "rule": ["a\n\n* * *", "a\n\n---", "a\n\n---\t", "a\n\n___ "],
    "image": ["![a](b)"],
    "link": ["[a](b)"],
    "span": ["a `b` c"],
    "strong": ["a **b** c", "a __b__ c"],
    "strike": ["a ~~b~~ c", "Across ~~an idle~~ line"],
    "bullet": ["* a", "+ a", "*\ta", "  * a", "\t+ a"],
    "em": ["a *b* c", "a _b_ c", "(_b_)", "a/_b_", "é, «_b_»", "a _(b)_ c"],
    "quote": ["> a", ">a", "  > a", "   > a", "\t> a"],
}


def test_each_construct_alone_is_found(spark):
    names = [g for g in (*M._LABEL, "tag", "begin", "command", "bare")]
    assert sorted(names) == sorted(ALONE)  # a construct without a case fails here
    texts = [t for cases in ALONE.values() for t in cases]
    for t in texts:
        assert M.markup_kinds(M.read_tree(t)), t
    blocks = spark.createDataFrame([(i, f"p{i}", "text", t) for i, t in enumerate(texts)], "block_id long, paper_id string, type string, text string")
    got = {r["block_id"] for r in M.clean_blocks(blocks).collect()}
    assert [t for i, t in enumerate(texts) if i not in got] == []
