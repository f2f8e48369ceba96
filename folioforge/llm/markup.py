"""Residue of HTML, Markdown, wiki and LaTeX markup in text, and clean text with its structure (problem 4).

Method: wrapper induction. Every block that may have markup is read into a tree whose nodes are constructs of any of the four
languages, whatever their names. Trees of one host (here: of one paper) with the same outline are a cluster, and so are trees
with the same outline anywhere; the trees of a cluster are aligned by simple tree matching with its most frequent tree, and
nodes that stand in the same place share a slot. Slots tell what is markup:

* a construct is markup where its label is constant while what it holds varies from page to page; a label for which no two
  aligned pages show that (a backslash in a path, a bracket in a formula) is plain text and stays as it is;
* a slot of a host whose content is the same on nearly all pages is template and left out of the clean text;
* varying slots are content, written with headings, lists, tables, code and formulas in plain notation.

General pages, two for each construct and name in common use, take part in the clusters like pages of the corpus, so that the
first page of a corpus is read like the last. A block is named for each language of which its tree has markup.

Only the counts of slots are ever grouped, in two steps, so a host of any size is no large group; every tree is aligned with
one tree of a cluster only, and a large tree is cut into pieces that are pages of their own.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import checkpointed

KINDS = ("html", "markdown", "wiki", "latex")
TYPES = ("text", "section_header")


@dataclass(frozen=True)
class MarkupPlan:
    """A slot is template if it has the same content on at least ``template_pages`` different pages of a host and on
    ``template_share`` of them. Trees of more than ``most_nodes`` nodes are cut into pieces. Up to ``most_labels`` labels that
    were found to be markup, and slots of up to ``most_shapes`` shapes, are broadcast; more are joined."""

    template_pages: int = 8
    template_share: float = 0.9
    most_nodes: int = 400
    most_labels: int = 100_000
    most_shapes: int = 20_000


# Names of HTML elements.
_BLOCK_TAGS = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul title caption".split())
_INLINE_TAGS = frozenset("a abbr b bdi bdo big br button center cite code col colgroup data del dfn em font i iframe img input ins kbd label link mark meta nobr noscript object option q s samp script select small span strike strong style sub sup svg textarea time tt u var video wbr".split())
_VOID = frozenset("br hr img input meta link wbr col".split())
_TAGS = _BLOCK_TAGS | _INLINE_TAGS
# Names of LaTeX commands and environments in common use.
_COMMANDS = tuple("author autoref bibliography bibliographystyle caption centerline chapter chemfig cite citeauthor citep citet date documentclass emph eqref footnote footnotemark footnotetext foreignlanguage frac gls hspace href include includegraphics index input keywords label mathbf mathit mathrm mbox newcommand nocite num pagestyle paragraph parbox part ref pageref SI section setcounter sqrt subparagraph subsection subsubsection textbf textcolor textit textmd textrm textsc textsf textsl textsubscript textsuperscript texttt textup thanks title underline unit uppercase url usepackage vspace".split())
_BARE = tuple("item par noindent newline newpage maketitle centering clearpage medskip bigskip smallskip hline tableofcontents ldots dots quad qquad LaTeX TeX textbackslash bf it em rm tt sc large small tiny normalsize indent appendix hfill vfill pagebreak linebreak toprule midrule bottomrule and cdot times pm alpha beta gamma delta mu".split())
_ENVIRONMENTS = tuple("abstract align array center cases definition description document enumerate equation eqnarray example figure flushleft flushright gather itemize lemma list lstlisting matrix minipage multline picture proof proposition quotation quote remark split table tabular thebibliography theorem titlepage verbatim verse".split())
_SETTINGS = frozenset("ref label cite citep citet citeauthor bibliography bibliographystyle usepackage documentclass vspace hspace includegraphics input footnotemark index pagestyle eqref pageref autoref".split())

#: What the JVM looks for before any text goes to Python: a superset of all markup, with something that each alternative of
#: _CONSTRUCT cannot do without.
MARKUP_JVM = r"(?m)<[a-zA-Z/!]|&[#a-zA-Z]|\\[a-zA-Z\[(%&$#_{}]|\$|\*\*|__|`|~~|\]\(|\[\[|\{\{|\{\||''|^#{1,6}[ \t]|^=|^-{3}|^[ \t]{0,3}>|^[ \t]*[*+][ \t]|\*\S|(?:^|\W)_\S"


@dataclass
class Node:
    label: str
    text: str = ""
    children: list[Node] = field(default_factory=list)
    #: What stands in the source: of an element that has an end, its beginning and its end, of others all of it.
    raw: str = ""
    end: str = ""
    is_open: bool = False

    @property
    def kind(self) -> str:
        return self.label.partition(":")[0]


_NAMES = "[A-Za-z][A-Za-z0-9-]*"
# One alternative for each construct; the first that matches at a place wins.
_CONSTRUCT = re.compile(
    rf"""
  (?P<fence>^(?P<mark>```|~~~)[ \w+-]*\n(?P<code>.*?)^(?P=mark)[ \t]*$)
 |(?P<comment><!--.*?(?:-->|\Z))
 |(?P<script><(?P<sname>(?i:script|style))\b[^>]*>.*?(?:</(?i:script|style)\s*>|\Z))
 |(?P<pre><(?i:pre)\b[^>]*>(?P<prein>.*?)(?:</(?i:pre)\s*>|\Z))
 |(?P<tag><(?P<close>/?)(?P<name>(?i:{_NAMES}))\b(?P<attrs>(?:\s+[\w:-]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*)\s*/?>)
 |(?P<doctype><!DOCTYPE[^>]*>)
 |(?P<entity>&(?:\#\d{{1,7}}|\#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]{{1,31}});)
 |(?P<wikitable>^\{{\|.*?^\|\}})
 |(?P<template>\{{\{{[^{{}}\n]{{1,400}}\}}\}})
 |(?P<wikilink>\[\[(?P<target>[^\[\]\n]{{1,300}})\]\])
 |(?P<wikihead>^(?P<eqs>={{1,6}})[ \t]*(?P<wtitle>[^=\n][^\n]*?)[ \t]*={{1,6}}[ \t]*$)
 |(?P<wikiemph>(?P<quotes>'{{2,5}})(?P<winner>[^'\n](?:.*?[^'\n])?)(?P=quotes))
 |(?P<display>\$\$(?P<dinner>.+?)\$\$|\\\[(?P<binner>.+?)\\\])
 |(?P<inline>(?<![\\\w$])\$(?=[^$\n]*[\\^_{{}}=])(?P<iinner>[^\s$](?:[^$\n]*[^\s$])?)\$(?![\w$])|\\\((?P<pinner>[^\n]+?)\\\))
 |(?P<begin>\\begin\{{(?P<env>[a-zA-Z]+\*?)\}}(?:\[[^\]\n]*\])?(?:\{{[^}}\n]*\}})?)
 |(?P<end>\\end\{{[a-zA-Z]+\*?\}})
 |(?P<command>~?\\(?P<cname>[a-zA-Z]+)\*?(?P<cargs>(?:\[[^\]\n]*\])?(?:\{{(?:[^{{}}]|\{{[^{{}}]*\}})*\}})+))
 |(?P<bare>(?<![\\\w:/.])\\(?P<bname>[a-zA-Z]{{2,}})\b(?![\\/]))
 |(?P<escape>(?<![\\\w:])\\[%&$\#_{{}}]|(?<=\d)\\[%&$\#])
 |(?P<mdhead>^\#{{1,6}}[ \t]+(?P<mtitle>\S.*?)[ \t]*\#*[ \t]*$)
 |(?P<setext>^(?=[^\n]*\n(?:={{3,}}|-{{3,}})[ \t]*$)(?P<stitle>[^\n]*\w[^\n]*)\n(?:={{3,}}|-{{3,}})[ \t]*$)
 |(?P<rule>^(?:\*[ ]?){{3,}}$|^-{{3,}}[ \t]*$|^_{{3,}}[ \t]*$)
 |(?P<image>!\[(?P<alt>[^\]\n]*)\]\([^()\s]*(?:[ ]"[^"\n]*")?\))
 |(?P<link>\[(?P<ltext>[^\[\]\n]+)\]\([^()\s]+(?:[ ]"[^"\n]*")?\))
 |(?P<span>(?<!`)`(?P<sinner>[^`\n]+)`(?!`))
 |(?P<strong>\*\*(?P<b1>[^\s*](?:[^*\n]*[^\s*])?)\*\*|(?<!\w)__(?P<b2>[^\s_](?:[^\n]*?[^\s_])?)__(?!\w))
 |(?P<strike>~~(?P<kinner>[^~\s](?:[^~\n]*[^~\s])?)~~)
 |(?P<bullet>^[ \t]*[*+][ \t]+(?=\S))
 |(?P<em>(?<![\w*\\])\*(?P<i1>[^\s*](?:[^*\n]*[^\s*])?)\*(?![\w*])|(?<![\w\\])_(?P<i2>[^\s_](?:[^_\n]*[^\s_])?)_(?!\w))
 |(?P<quote>^[ \t]{{0,3}}>[ \t]?)
""",
    re.MULTILINE | re.DOTALL | re.VERBOSE,
)
_LABEL = {
    "fence": "markdown:code", "comment": "html:comment", "script": "html:script", "pre": "html:pre", "doctype": "html:doctype", "entity": "html:entity", "wikitable": "wiki:table", "template": "wiki:template", "wikilink": "wiki:link",
    "wikihead": "wiki:heading", "wikiemph": "wiki:emphasis", "display": "latex:display", "inline": "latex:inline", "end": "latex:end", "escape": "latex:escape", "mdhead": "markdown:heading", "setext": "markdown:heading", "rule": "markdown:rule",
    "image": "markdown:image", "link": "markdown:link", "span": "markdown:span", "strong": "markdown:strong", "strike": "markdown:strike", "bullet": "markdown:item", "em": "markdown:em", "quote": "markdown:quote",
}
_INNER = {"wikihead": ("wtitle",), "wikiemph": ("winner",), "mdhead": ("mtitle",), "setext": ("stitle",), "link": ("ltext",), "strong": ("b1", "b2"), "strike": ("kinner",), "em": ("i1", "i2")}


#: Elements nested deeper than this stand beside each other.
_DEEPEST = 60


def read_tree(text: str) -> Node:
    """The tree of a text; its leaves are texts and the elements without content."""
    root = Node("root")
    stack = [root]
    at = 0

    def add(node: Node) -> None:
        stack[-1].children.append(node)

    def opened(node: Node) -> None:
        node.is_open = True
        add(node)
        if len(stack) < _DEEPEST:
            stack.append(node)

    for m in _CONSTRUCT.finditer(text):
        group = m.lastgroup if m.lastgroup in _LABEL else next(g for g in (*_LABEL, "tag", "begin", "command", "bare") if m[g] is not None)
        if group == "entity" and html.unescape(m[0]) == m[0]:
            continue
        if m.start() > at:
            add(Node("text", text[at : m.start()]))
        at = m.end()
        raw = m[0]
        if group == "tag":
            name = m["name"].lower()
            if not m["close"]:
                node = Node(f"html:{name}", raw=raw)
                if name in _VOID:
                    add(node)
                else:
                    if name in ("li", "td", "th", "tr", "p", "dd", "dt") and stack[-1].label == node.label:
                        stack.pop()  # an element that ends where the next begins
                    opened(node)
            else:
                heading = re.fullmatch(r"h[1-6]", name)
                own = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].label == f"html:{name}"), 0)
                own = own or (next((i for i in range(len(stack) - 1, 0, -1) if re.fullmatch(r"html:h[1-6]", stack[i].label)), 0) if heading else 0)
                if own:
                    stack[own].end = raw
                    del stack[own:]
                else:
                    add(Node(f"html:/{name}", raw=raw))
        elif group == "begin":
            opened(Node("latex:env", raw=raw))
        elif group == "end":
            own = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].label.startswith("latex:env")), 0)
            if own:
                stack[own].end = raw
                del stack[own:]
            else:
                add(Node("latex:end", raw=raw))
        elif group == "command":
            name = m["cname"]
            node = Node(f"latex:command:{name}", raw=raw)
            if name not in _SETTINGS:
                args = re.findall(r"\{((?:[^{}]|\{[^{}]*\})*)\}", m["cargs"])
                node.children = [c for a in args for c in read_tree(a).children] if len(args) == 1 else [Node("text", raw.lstrip("~"))]
            add(node)
        elif group == "bare":
            name = m["bname"]
            add(Node("latex:item" if name == "item" else f"latex:bare:{name}", "…" if name in ("ldots", "dots") else "", raw=raw))
        elif group in _INNER:
            inner = next(m[g] for g in _INNER[group] if m[g] is not None)
            add(Node(_LABEL[group], children=read_tree(inner).children, raw=raw))
        elif group == "fence":
            add(Node(_LABEL[group], m["code"], raw=raw))
        elif group == "pre":
            add(Node(_LABEL[group], html.unescape(re.sub(r"</?\w+[^>]*>", "", m["prein"])), raw=raw))
        elif group == "wikilink":
            add(_wiki_link(m["target"], raw))
        elif group in ("display", "inline"):
            add(Node(_LABEL[group], next(m[g] for g in ("dinner", "binner", "iinner", "pinner") if m[g] is not None).strip(), raw=raw))
        elif group in ("image", "span"):
            add(Node(_LABEL[group], m["alt"] if group == "image" else m["sinner"], raw=raw))
        else:
            add(Node(_LABEL[group], raw, raw=raw))
    if at < len(text):
        add(Node("text", text[at:]))
    return root


def _wiki_link(target: str, raw: str) -> Node:
    head, _, rest = target.partition("|")
    space = re.match(r"(?i)(file|image|category|datei|bild|kategorie|fichier|archivo|catégorie|categoría|categoria|файл|категория):", head)
    if space:
        caption = rest.rpartition("|")[2]
        kind = "category" if space[1].lower().startswith(("cat", "kat", "кат")) else "file"
        return Node(f"wiki:{kind}", "" if "=" in caption else caption, raw=raw)
    return Node("wiki:link", rest or head, raw=raw)


def walk(node: Node) -> Iterator[Node]:
    for c in node.children:
        yield c
        yield from walk(c)


def markup_kinds(root: Node, known: frozenset[str] | None = None) -> list[str]:
    """The languages of which the tree has markup: nodes of a label that is ``known`` to be such."""
    found = {n.kind for n in walk(root) if known is None or n.label in known}
    return [k for k in KINDS if k in found]


# --- writing -----------------------------------------------------------------------------------------------------------------

_HEADINGS = re.compile(r"html:h[1-6]|html:title|wiki:heading|markdown:heading|latex:command:(?:part|chapter|(?:sub)*section|(?:sub)?paragraph|title)")


def write(node: Node, dropped: frozenset[int] = frozenset(), numbers: dict[int, int] | None = None, known: frozenset[str] | None = None) -> str:
    """The clean text of a tree: headings as lines of their own, lists with dashes, tables with bars, code and formulas as
    they are; nodes whose numbers are in ``dropped`` are left out with all below them, and what is not ``known`` to be markup
    stands as in the source."""
    numbers = numbers if numbers is not None else {id(n): i for i, n in enumerate(walk(node))}
    out: list[str] = []

    def inner(n: Node) -> str:
        return write(n, dropped, numbers, known)

    for n in node.children:
        if numbers.get(id(n)) in dropped:
            continue
        label = n.label
        if label == "text":
            out.append(n.text)
        elif known is not None and label not in known:
            out.append(n.raw + (inner(n) + n.end if n.is_open else ""))
        elif _HEADINGS.fullmatch(label):
            out.append("\n\n" + " ".join(inner(n).split()) + "\n\n")
        elif label in ("html:comment", "html:script", "html:doctype", "wiki:category", "wiki:template", "markdown:rule", "latex:end") or label.startswith("html:/"):
            out.append(" " if label == "wiki:template" else "")
        elif label == "html:entity":
            out.append(html.unescape(n.text).replace("\xa0", " "))
        elif label in ("html:br", "html:hr"):
            out.append("\n")
        elif label in ("html:pre", "markdown:code"):
            out.append("\n\n" + "\n".join("    " + line for line in n.text.strip("\n").split("\n")) + "\n\n")
        elif label in ("html:li", "html:dd", "html:dt"):
            out.append("\n- " + inner(n).strip())
        elif label == "html:tr":
            cells = [c for c in n.children if c.label in ("html:td", "html:th") and numbers.get(id(c)) not in dropped]
            out.append("\n| " + " | ".join(" ".join(inner(c).split()) for c in cells) + " |\n" if cells else inner(n))
        elif label == "wiki:table":
            out.append("\n\n" + _wiki_table(n.text) + "\n\n")
        elif label == "latex:display":
            out.append("\n\n" + n.text + "\n\n")
        elif label in ("latex:item", "markdown:item"):
            out.append(("" if label == "markdown:item" else "\n") + "- ")
        elif label == "latex:escape":
            out.append(n.text[-1])
        elif label == "markdown:quote":
            continue
        elif label.startswith("latex:env"):
            out.append("\n\n" + inner(n).strip() + "\n\n")
        elif n.children:
            block = label.partition(":")[2] in _BLOCK_TAGS
            out.append("\n\n" + inner(n).strip() + "\n\n" if block else inner(n))
        elif label not in ("wiki:file", "markdown:image") or n.text:
            out.append(n.text)
    text = "".join(out)
    if node.label == "root":
        text = re.sub(r"[ \t]+\n", "\n", text)
        text = re.sub(r"(?<=\S)[ \t]{2,}", " ", text)
        text = re.sub(r"- \n+", "- ", text)
        text = re.sub(r"\n{3,}", "\n\n", text).strip("\n ")
    return text


def _wiki_table(source: str) -> str:
    rows, row = [], []
    for line in source.split("\n")[1:-1]:
        line = line.strip()
        if line.startswith("|-"):
            rows.append(row)
            row = []
        elif line[:1] in "|!":
            row += [x.strip() for x in re.split(r"\|\||!!", line[1:])]
    return "\n".join("| " + " | ".join(r) + " |" for r in [*rows, row] if r)


# --- wrapper induction ---------------------------------------------------------------------------------------------------------


def signature(node: Node) -> list:
    """The shape of a tree: labels, without texts."""
    return [node.label, [signature(c) for c in node.children]]


def align(a: list, b: list) -> dict[int, int]:
    """Simple tree matching of two shapes: the largest set of matching nodes in the same order and under matching parents, as
    numbers in preorder (the root has none). Equal subtrees at the beginning and at the end of two lists of children match each
    other in one of the best matchings, so only what lies between them is compared pair by pair."""

    def size(t: list) -> int:
        return 1 + sum(map(size, t[1]))

    def equal(x: list, at_x: int, at_y: int) -> list[tuple[int, int]]:
        return [(at_x + i, at_y + i) for i in range(size(x))]

    def match(x: list, y: list, at_x: int, at_y: int) -> tuple[int, list[tuple[int, int]]]:
        if x[0] != y[0]:
            return 0, []
        xs, ys = x[1], y[1]
        start_x, start_y, p, q = [], [], at_x + 1, at_y + 1
        for t in xs:
            start_x.append(p)
            p += size(t)
        for t in ys:
            start_y.append(q)
            q += size(t)
        out = [(at_x, at_y)]
        first, last_x, last_y = 0, len(xs), len(ys)
        while first < min(last_x, last_y) and xs[first] == ys[first]:
            out += equal(xs[first], start_x[first], start_y[first])
            first += 1
        while min(last_x, last_y) > first and xs[last_x - 1] == ys[last_y - 1]:
            last_x, last_y = last_x - 1, last_y - 1
            out += equal(xs[last_x], start_x[last_x], start_y[last_y])
        rows, columns = last_x - first, last_y - first
        best = [[(0, None)] * (columns + 1) for _ in range(rows + 1)]
        for i in range(1, rows + 1):
            for j in range(1, columns + 1):
                w, pairs = match(xs[first + i - 1], ys[first + j - 1], start_x[first + i - 1], start_y[first + j - 1])
                both = (best[i - 1][j - 1][0] + w, pairs) if w else (-1, "no")
                best[i][j] = max((best[i - 1][j][0], "up"), (best[i][j - 1][0], "left"), both, key=lambda z: z[0])
        i, j = rows, columns
        while i and j:
            step = best[i][j][1]
            if step == "up":
                i -= 1
            elif step == "left":
                j -= 1
            else:
                out += step
                i, j = i - 1, j - 1
        return len(out), out

    return dict(pair for pair in match(a, b, -1, -1)[1] if pair[0] >= 0)


def pieces(root: Node, most: int) -> list[tuple[list, list[int]]]:
    """(shape, numbers of its nodes in preorder) of the pages into which a tree is cut: itself, or pieces of up to ``most``
    nodes, runs of children that follow each other; a child with more nodes than that stands without its own children, which
    are pieces again."""
    numbers = {id(n): i for i, n in enumerate(walk(root))}
    out: list[tuple[list, list[int]]] = []

    def cut(children: list[Node]) -> None:
        shape, own = ["root", []], []
        for c in children:
            below = [c, *walk(c)]
            if own and len(own) + (1 if len(below) > most else len(below)) > most:
                out.append((shape, own))
                shape, own = ["root", []], []
            if len(below) > most:
                shape[1].append([c.label, []])
                own.append(numbers[id(c)])
                cut(c.children)
            else:
                shape[1].append(signature(c))
                own += [numbers[id(n)] for n in below]
        if own:
            out.append((shape, own))

    cut(root.children)
    return out


def outline(shape: list) -> str:
    """What trees of a cluster share: the labels of the top level in their order, without texts and repetitions."""
    labels = [c[0] for c in shape[1] if c[0] != "text"]
    return " ".join(x for i, x in enumerate(labels) if not i or labels[i - 1] != x)


def contents(root: Node) -> list[int]:
    """A hash of what each node holds, in preorder: its own text and the text behind it."""
    out = []

    def visit(node: Node) -> None:
        for i, c in enumerate(node.children):
            behind = node.children[i + 1].text if i + 1 < len(node.children) and node.children[i + 1].label == "text" and c.label != "text" else ""
            own = " ".join((_own_text(c) + " \x00 " + behind).split())
            out.append(xxhash.xxh3_64_intdigest(own) - (1 << 63))
            visit(c)

    visit(root)
    return out


def _own_text(n: Node) -> str:
    return n.text + "".join(c.text for c in walk(n))


def general_pages() -> list[str]:
    """Two pages for each construct and name in common use: the same markup with other content."""
    frames = [f"<{t}>" + ("%" if t in _VOID else f"%</{t}>") + " %" for t in sorted(_TAGS)] + [f"%</{t}> %" for t in sorted(_TAGS - _VOID)]
    frames += ["<!-- % --> %", "<script>%</script> %", "<style>%</style> %", "<pre>%</pre> %", "<!DOCTYPE html> %", "% &amp; %"]
    frames += [f"\\{c}{{%}} %" for c in _COMMANDS] + [f"\\{c} %" for c in _BARE] + [f"\\begin{{{e}}} % \\end{{{e}}} %" for e in _ENVIRONMENTS]
    frames += ["% \\end{center} %", "$$ % $$ %", "\\[ % \\] %", "$% = x_1$ %", "\\( % \\) %", "% 5\\% %"]
    frames += ["```\n%\n```\n%", "## %\n%", "%\n====\n%", "%\n\n***\n\n%", "![%](a.png) %", "[%](a) %", "`%` %", "**%** %", "~~%~~ %", "* %\n* %", "*%* %", "> %\n> %"]
    frames += ["{|\n| %\n|}\n%", "{{%}} %", "[[%]] %", "== % ==\n%", "''%'' %", "[[Category:%]] %", "[[File:%]] %"]
    return [f.replace("5\\%", "\x01").replace("%", word).replace("\x01", "5\\%") for f in frames for word in ("alpha one", "beta two")]


# --- operator -----------------------------------------------------------------------------------------------------------------

_PIECES = "array<struct<shape: string, outline: string, nodes: array<int>, contents: array<long>>>"


def read_blocks(blocks: DataFrame, plan: MarkupPlan) -> DataFrame:
    """(block_id, host, text, labels, pieces) of the blocks that may have markup: the labels of their constructs, and for each
    piece of the tree its shape, outline, the numbers of its nodes and what they hold."""
    piece = pa.struct([("shape", pa.string()), ("outline", pa.string()), ("nodes", pa.list_(pa.int32())), ("contents", pa.list_(pa.int64()))])
    columns = {"block_id": pa.int64(), "host": pa.string(), "text": pa.string(), "labels": pa.list_(pa.string()), "pieces": pa.list_(piece)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                root = read_tree(text)
                if labels := sorted({n.label for n in walk(root)} - {"text"}):
                    held = contents(root)
                    cut = [{"shape": json.dumps(shape, separators=(",", ":")), "outline": outline(shape), "nodes": own, "contents": [held[i] for i in own]} for shape, own in pieces(root, plan.most_nodes)]
                    rows.append((block, host, text, labels, cut))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(columns.values())], names=list(columns))

    return blocks.mapInArrow(run, f"block_id long, host string, text string, labels array<string>, pieces {_PIECES}")


def _aligned(shapes: DataFrame) -> DataFrame:
    """(host, outline, shape, slots, labels) of (host, outline, shape, model): for each node its node in the model, or -1."""

    def labels_of(t: list) -> Iterator[str]:
        for c in t[1]:
            yield c[0]
            yield from labels_of(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, labels = [], []
            for shape, model in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a = json.loads(shape)
                labels.append(list(labels_of(a)))
                pairs = align(a, a if shape == model else json.loads(model))
                slots.append([pairs.get(i, -1) for i in range(len(labels[-1]))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(slots, pa.list_(pa.int32())), pa.array(labels, pa.list_(pa.string()))], names=["host", "outline", "shape", "slots", "labels"])

    return shapes.mapInArrow(run, "host string, outline string, shape string, slots array<int>, labels array<string>")


_CLUSTER = ["host", "outline"]


def induce(pages: DataFrame, plan: MarkupPlan) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(labels that are markup, slots that are template (host, outline, template), slots of each shape) from ``pages`` as
    ``read_blocks`` gives them and the general pages. Pages of the same content count once."""
    spark = pages.sparkSession
    general = spark.createDataFrame([(i, "", t) for i, t in enumerate(general_pages())], "block_id long, host string, text string")
    seen = pages.select(F.concat(F.lit("h"), F.coalesce("host", F.lit(""))).alias("host"), F.explode("pieces").alias("p"))
    seen = seen.unionByName(read_blocks(general, plan).select(F.lit("h").alias("host"), F.explode("pieces").alias("p")))
    # Every page stands in the cluster of its host and in that of all hosts.
    both = F.explode(F.array("host", F.lit("all"))).alias("host")
    distinct = checkpointed(seen.select(both, "p.outline", "p.shape", "p.contents").distinct())
    shapes = distinct.groupBy(*_CLUSTER, "shape").agg(F.count("*").alias("pages"))
    models = shapes.groupBy(_CLUSTER).agg(F.max_by("shape", F.struct("pages", "shape")).alias("model"))
    slots = checkpointed(_aligned(shapes.join(models, _CLUSTER).select(*_CLUSTER, "shape", "model")))
    # Pages of one shape may be many: while shapes are few, their slots go to the pages, and no page is moved.
    slots = F.broadcast(slots) if slots.limit(plan.most_shapes + 1).count() <= plan.most_shapes else slots
    placed = distinct.join(slots, [*_CLUSTER, "shape"]).select(*_CLUSTER, F.explode(F.arrays_zip("slots", "labels", "contents")).alias("n"))
    by_content = placed.filter("n.slots >= 0").groupBy(*_CLUSTER, F.col("n.slots").alias("slot"), F.col("n.labels").alias("label"), F.col("n.contents").alias("content")).agg(F.count("*").alias("n"))
    by_slot = by_content.groupBy(*_CLUSTER, "slot", "label").agg(F.max("n").alias("top"), F.sum("n").alias("all"), (F.min("content") != F.max("content")).alias("varies"))
    by_slot = checkpointed(by_slot)
    labels = by_slot.filter("varies and label <> 'text'").select("label").distinct()
    constant = (F.col("top") >= plan.template_pages) & (F.col("top") >= plan.template_share * F.col("all"))
    template = by_slot.filter((F.col("host") != "all") & constant).groupBy(_CLUSTER).agg(F.collect_set("slot").alias("template"))
    return checkpointed(labels), checkpointed(template), slots


def _stands_alone(n: Node) -> bool:
    """Whether a node may be template: elements with lines of their own, but no headings; what stands within a sentence is no
    template, however often the sentence is met."""
    return n.label in ("wiki:template", "wiki:table") or (n.kind == "html" and n.label.partition(":")[2] in _BLOCK_TAGS and not _HEADINGS.fullmatch(n.label))


def clean_blocks(blocks: DataFrame, plan: MarkupPlan | None = None) -> DataFrame:
    """(block_id, kinds, clean) of the blocks of type text or section_header whose text has residue of markup.

    ``kinds`` are the languages present, ``clean`` the text without markup and template. Null and empty texts have none;
    blocks without a host are aligned among themselves; repeated rows each give their row.
    """
    plan = plan or MarkupPlan()
    source = blocks.filter(F.col("type").isin(*TYPES) & F.col("text").rlike(MARKUP_JVM)).select("block_id", F.col("paper_id").alias("host"), "text")
    pages = checkpointed(read_blocks(source, plan))
    labels, template, slots = induce(pages, plan)

    marked = pages.select("block_id", "text", "labels", F.lit(None).cast("array<int>").alias("gone"))
    if not template.isEmpty():
        at = F.filter(F.transform("slots", lambda s, i: F.when(F.array_contains("template", s), i)), lambda i: i.isNotNull())
        dropped = slots.join(template, _CLUSTER).select(*_CLUSTER, "shape", at.alias("at")).filter("size(at) > 0")
        numbered = checkpointed(pages.withColumn("row", F.monotonically_increasing_id()))
        own = numbered.select("row", F.concat(F.lit("h"), F.coalesce("host", F.lit(""))).alias("host"), F.explode("pieces").alias("p")).select("row", "host", "p.outline", "p.shape", "p.nodes")
        gone = own.join(dropped, [*_CLUSTER, "shape"]).groupBy("row").agg(F.flatten(F.collect_list(F.transform("at", lambda i: F.get("nodes", i)))).alias("gone"))
        marked = numbered.join(gone, "row", "left").select("block_id", "text", "labels", "gone")

    def run_with(get) -> callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for block, text, own, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    known = get(own)
                    root = read_tree(text)
                    if kinds := markup_kinds(root, known):
                        left_out = frozenset(i for i, n in enumerate(walk(root)) if i in gone and _stands_alone(n)) if gone else frozenset()
                        rows.append((block, kinds, write(root, left_out, None, known)))
                types = (pa.int64(), pa.list_(pa.string()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["block_id", "kinds", "clean"])

        return run

    out = "block_id long, kinds array<string>, clean string"
    if labels.limit(plan.most_labels + 1).count() <= plan.most_labels:
        shared = blocks.sparkSession.sparkContext.broadcast(frozenset(r["label"] for r in labels.collect()))
        return marked.mapInArrow(run_with(lambda own: shared.value), out)
    # Too many for a broadcast: every block gets those of its own labels that are markup.
    numbered = checkpointed(marked.withColumn("row", F.monotonically_increasing_id()))
    known = numbered.select("row", F.explode("labels").alias("label")).join(labels, "label").groupBy("row").agg(F.collect_list("label").alias("known"))
    return numbered.join(known, "row").select("block_id", "text", F.col("known").alias("labels"), "gone").mapInArrow(run_with(frozenset), out)
