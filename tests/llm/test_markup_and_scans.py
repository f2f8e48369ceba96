import random

import pytest

from folioforge.llm import markup as M
from folioforge.llm import scan_noise as S


@pytest.mark.parametrize(
    ("text", "kinds", "clean"),
    [
        ("<b>Error Budget</b>", ["html"], "Error Budget"),
        ('<h1 class="hd">Limits</h3>\n<div id=\'b\'>One.</div>', ["html"], "Limits\n\nOne."),
        ("<UL>\n<LI>one</LI>\n<LI>two</LI>\n</UL>", ["html"], "- one\n\n- two"),
        ("a &lt;0.05&#x2009;&mu;m", ["html"], "a <0.05\u2009μm"),
        ("x<!-- note -->y<script>track(7);</script>", ["html"], "xy"),
        ("<table><tr><th>a</th><td>1</td></tr></table>", ["html"], "| a | 1 |"),
        ("## Head\n\nText **bold** and [link](u).", ["markdown"], "Head\n\nText bold and link."),
        ("Head\n=====\nText", ["markdown"], "Head\n\nText"),
        ("```sh\nfor x:\n  y\n```", ["markdown"], "for x:\n      y"),
        ("> quoted\n> more", ["markdown"], "quoted\nmore"),
        ("* *one*\n+ two", ["markdown"], "- one\n- two"),
        ("== Head ==\n'''Bold''' [[a|b]] {{t|x=1}}", ["wiki"], "Head\n\nBold b"),
        ("{| class=\"g\"\n! run !! value\n|-\n| 1 || 2\n|}", ["wiki"], "| run | value |\n| 1 | 2 |"),
        ("t [[Category:Reefs]] [[File:x.png|thumb|cap]]", ["wiki"], "t cap"),
        ("\\section{Head}\nText \\emph{x}~\\cite{y} 5\\%", ["latex"], "Head\n\nText x 5%"),
        ("\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}", ["latex"], "- one\n\n- two"),
        ("Here $\\alpha_{2} = 3$ and\n$$x^2$$", ["latex"], "Here \\alpha_{2} = 3 and\n\nx^2"),
    ],
)
def test_markup(text, kinds, clean):
    root = M.read_tree(text)
    assert M.markup_kinds(root) == kinds
    assert M.write(root) == clean


@pytest.mark.parametrize("text", ["", "a < 5 and b > 3", "cost $5 and $7, as in [12]", "C:\\rig\\new as a/b = c", "{1, 2, 4} split 2*3*4 ways by R&D", "V = [1, 0] and |v| = 2", "A_1_x and snake_case_2", "- item\n- 9 -", "#82", "it's 5' 3''"])
def test_no_markup(text):
    assert M.markup_kinds(M.read_tree(text)) == []


def brute_match(a, b):
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i in range(1, len(a[1]) + 1):
        for j in range(1, len(b[1]) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + brute_match(a[1][i - 1], b[1][j - 1]))
    return best[-1][-1] + 1


def test_alignment():
    rng = random.Random(3)

    def tree(depth):
        return [rng.choice("ab"), [tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]]

    for _ in range(150):
        a, b = ["root", tree(3)[1]], ["root", tree(3)[1]]
        pairs = M.align(a, b)
        assert len(pairs) == brute_match(a, b) - 1 and [v for _, v in sorted(pairs.items())] == sorted(pairs.values())


def test_template(spark):
    rows = [(i, "host", "text", f"<div><p>Site notice</p><p>Content number {i}</p></div>") for i in range(12)] + [(100, None, "text", "<b>x</b>"), (101, "host", "table", "<b>x</b>"), (102, "host", "text", None), (103, "host", "text", ""), (104, "o", "section_header", "<b>H</b>"), (104, "o", "section_header", "<b>H</b>")]
    df = spark.createDataFrame(rows, "block_id long, paper_id string, type string, text string").selectExpr("*", "'z' as kinds", "'y' as host")
    got = {}
    for r in M.clean_blocks(df).collect():
        got.setdefault(r["block_id"], []).append(r["clean"])
    assert got[3] == ["Content number 3"] and got[100] == ["x"] and got[104] == ["H", "H"] and set(got) == {*range(12), 100, 104}
    assert M.clean_blocks(df.limit(0)).count() == 0


# --- scans ---------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("line", ["Page 12", "– 4 –", "- 17 -", "[3]", "p. 9", "3 / 40", "xxii", "Vol. 31, No. 10", "12   Vol. 3, No. 1", "Doe et al.", "DOE ET AL. | 4", "Journal of Slow Hydrology   7", "HOW THE STABLE REEF LIMITS FLOW", "12   Cyclic loading of the electr", "Cyclic loading of reefs | 7"])
def test_noise_lines(line):
    assert S.noise_lines(["The first line goes", line, "on with this text."]) == [False, True, False]


@pytest.mark.parametrize("line", ["replaced after 5 hours.", "mg.", "Limitations of", "It was 5.", "a", "in 2021.", "{| class=\"x\"", "== Head ==", "```", "I"])
def test_text_lines(line):
    assert S.noise_lines(["The first line goes", line, "on with this text."])[1] is False


def test_own_titles():
    own = (S._key("Das Sediment begrenzt die Körnung nach zwölf Stunden"),)
    noise = lambda *lines: S.noise_lines(list(lines), own)
    assert noise("Es begrenzt", "Das Sediment begrenzt die Körn", "nichts.") == [False, True, False]
    assert noise("Es begrenzt", "Das Sediment begrenzt die", "Rissbildung nicht.") == [False, True, False]
    assert noise("Es begrenzt.", "Das Sediment begrenzt die", "Rissbildung nicht.") == [False, False, False]
    assert noise("Es begrenzt", "Das Sediment begrenzt die", "Körnung nicht.") == [False, False, False]
    assert noise("- Es.", "- Das Sediment begrenzt die Körnung nach zwölf Stunden.", "- Es.") == [False] * 3
    assert noise("Es.", "Das Sediment begrenzt die Körnung nach zwölf Stunden.", "Es.") == [False] * 3


def test_distance():
    assert S.misreading("modern", "modem") < 1 and S.misreading("small", "srnall") < 1 and S.misreading("loss", "1oss") < 1 and S.misreading("rinsing", "rirising") < 1
    assert S.misreading("control", "ntrol") >= 1 and S.misreading("basin", "basins") >= 1 and S.misreading("cat", "cat") == 0
    assert S.deletes("abc", 1) == {"abc", "_bc", "a_c", "ab_"}
    assert S.misreading("a" * 90 + "m" + "b" * 90, "a" * 90 + "rn" + "b" * 90) < 1


def corpus(spark):
    sentence = "the modern reservoir limits the flow of small particles in winter while the old thin-section counts stay high"
    rows = [(i, "text", sentence) for i in range(300)]
    rows += [(1000, "text", "the modem reservoir limits the flow of srnall particles"), (1001, "text", "the reser-\nvoir limits the flow"), (1002, "text", "the old thin-\nsection counts stay"), (1003, "text", "the modern\nPage 12\nreservoir limits"), (1004, "text", "the modern\nreservoir limits")]
    rows += [(1005, "table", "the modem reservoir"), (1006, "text", None), (1007, "text", ""), (1008, None, "the reservoir 1imits the flow"), (1009, "text", "an unknown w0rdle stands here"), (1001, "text", "the reser-\nvoir limits the flow")]
    rows += [(1010, "text", "the modern\nOn the flow of parti\nreservoir limits"), (1012, "text", "the modern reservoir.\n\nLetters on Rivers and Dams\nThe flow is small."), (1011, "text", "the modern\non the flow of\nparticles in winter stay")]
    return spark.createDataFrame(rows, "block_id long, type string, text string").selectExpr("*", "1 as n", "'x' as repaired", "'p' as paper_id")


def titles(spark):
    return spark.createDataFrame([("p", "On the flow of particles in winter"), ("p", None), ("p", "On the flow of particles in winter"), (None, "A title of nothing at all")], "paper_id string, title string").selectExpr("*", "'Letters on Rivers and Dams' as journal")


@pytest.mark.parametrize("most", [400_000, 0])
def test_repair(spark, most):
    got = [(r["block_id"], r["repaired"]) for r in S.repair_blocks(corpus(spark), titles(spark), S.ScanPlan(most_decisions=most)).collect()]
    assert sorted(got) == [
        (1000, "the modern reservoir limits the flow of small particles"), (1001, "the reservoir limits the flow"), (1001, "the reservoir limits the flow"), (1003, "the modern reservoir limits"), (1008, "the reservoir limits the flow"), (1010, "the modern reservoir limits"), (1012, "the modern reservoir.\n\nThe flow is small."),
    ]


def test_no_blocks(spark):
    assert S.repair_blocks(corpus(spark).limit(0)).count() == 0
