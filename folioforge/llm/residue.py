"""Template residue, filler, error pages and script notices in place of real content (problem 10).

Method. Character n-gram models of residue (filler; error pages and notices; keyboard mash) and of natural prose are compared
window by window: sentences and lines, long ones in pieces. A window is residue if the log likelihood ratio says so, and a
document is excluded if residue covers most of its body; a title before it is not counted. The residue models start from
general examples, the prose model from all documents. Then the models learn from the documents themselves: windows of those
that residue covers join the residue models, the others the prose model. Whatever is counted is counted over every row, in
passes over the table that each return sums of a bounded size; nothing depends on how the table is stored.

Placeholders are scored likewise. Every span between delimiters, and every word without small letters, is a candidate; n-gram
models of unfilled fields (made from delimiters and field names by rule) and of the candidates of the corpus are compared. A
placeholder is one that was left unfilled, not one that is talked about: its sentence is scored by models of sentences about
notation and of prose. One placeholder is enough to exclude a document.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import checkpointed


@dataclass(frozen=True)
class ResiduePlan:
    """``coverage`` of the body must be residue. The models learn ``rounds`` times from documents with a share of ``learn``."""

    coverage: float = 0.6
    learn: float = 0.5
    order: int = 4
    buckets: int = 1 << 18
    window: int = 90
    rounds: int = 4
    seed: int = 5


# General examples from which the models start. None of them is taken from a table.
FILLER = """
Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam eaque ipsa quae ab illo inventore veritatis.
Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt.
At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores.
Lorem ipsum dolor sit amet, consetetur sadipscing elitr, sed diam nonumy eirmod tempor invidunt ut labore et dolore magna aliquyam erat, sed diam voluptua.
Vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae, integer in mauris eu nibh euismod gravida.
Temporibus autem quibusdam et aut officiis debitis aut rerum necessitatibus saepe eveniet ut et voluptates repudiandae sint et molestiae non recusandae.
Weit hinten, hinter den Wortbergen, fern der Länder Vokalien und Konsonantien leben die Blindtexte.
Hallo, ich bin ein kleiner Blindtext, und zwar schon so lange ich denken kann. Dies ist ein Typoblindtext, an ihm kann man sehen, ob alle Buchstaben da sind und wie sie aussehen.
Dieser Absatz dient nur als Platzhalter im Layout. Ersetzen Sie diesen Blindtext durch Ihren eigenen Inhalt.
The quick brown fox jumps over the lazy dog. Pack my box with five dozen liquor jugs.
This text only stands in for the copy that will be written later. Dummy copy to show how the finished layout is going to look.
Put your own words in place of this sample paragraph. Placeholder paragraph: swap it for real content before you publish. Test paragraph for the layout, to be replaced.
Here goes the body copy of your article. Put a short description of the product in this spot. Add a headline of up to ten words. Enter your heading here. Insert the text of your section here.
Describe your study in two or three sentences, without citations. State the aim, methods and results in at most 200 words. List three to five keywords. Give the full names of all authors.
Nothing has been entered in this section so far. The following leaf is blank intentionally. (Page intentionally blank.) Template text, not for publication. Some example content for testing the design. This page has been left empty on purpose. More content is coming shortly.
Section one, section two, section three. Heading, subheading, body. Author A, Author B, Author C. Keyword one, keyword two. First Author, Second Author, Third Author. Name of the university, city, country.
sample sample sample sample sample sample. dummy dummy dummy dummy. aaa bbb ccc aaa bbb ccc. one two three one two three. hello world hello world. lorem lorem lorem ipsum ipsum ipsum. blah blah blah. xx xxx xxxx xxx xx xxx xxxx xxx xxx xx. example example example example.
Ce paragraphe sert seulement à remplir la maquette. Remplacez ces mots par votre propre texte. Texte provisoire.
Este párrafo solo sirve para llenar el espacio de la maqueta. Sustituya estas palabras por su propio texto. Texto de prueba.
Este parágrafo serve apenas para preencher o espaço do leiaute. Substitua estas palavras pelo seu próprio texto. Texto de teste.
Этот абзац нужен лишь для заполнения макета. Замените эти слова своим текстом. Пробный текст.
Questo paragrafo serve solo a riempire lo spazio. Deze alinea dient alleen als voorbeeld van de opmaak, vul hier uw eigen tekst in.
"""
NOTICES = """
Sorry, we could not find the page you were looking for (error 404). The address may be mistyped, or the page has moved. Nothing was found at this location. That page does not exist any more. Whoever sent you this link had it wrong.
HTTP error 404: no such document on this host. The file is missing, it could not be opened (code 12). 404 - file or directory not found. Error code 410, the resource is gone for good. We searched everywhere, but this page seems to have wandered off.
HTTP error 403: you are forbidden to view this directory. Your account has no permission for this resource. Access to this content is restricted to subscribers. You are not authorised to see this page. 401 authorization required. You need a licence to read this text.
HTTP error 500: the server met an internal problem and could not complete your request. Whoops, something broke on our side. An unexpected failure occurred while processing the request, please retry in a few minutes. Internal error, contact support.
HTTP error 502: the gateway got an invalid answer from the upstream host. 503: the service is down for scheduled maintenance, we will be back soon. 504: the gateway timed out. The connection has timed out. The server is overloaded at the moment. The site cannot be reached.
HTTP error 429: your network has sent too many requests, slow down and retry later. You have reached the limit of downloads for today. Error 400: the request was malformed. Error 408: request timeout. Status 500. Status 503. Code 404. Trace id 00ab12cd. Incident number 5f3c2a1. Event reference no. 88e0d1f. Powered by apache. Served by nginx.
The file that was requested is broken and cannot be shown. Failed to render the document. The viewer could not load the file. Unable to open the attachment. Preview is not available for this item. The database did not respond. Out of memory. Connection closed by the remote host. Conversion of the document has failed.
The item was withdrawn by its owner or deleted. The identifier you entered does not resolve. No record matches this identifier. Your search gave no results. Please report this to the webmaster of the repository if you think it is a mistake.
Unhandled exception at line 42. Traceback of the last call: file "main.py", line 7, in run, TypeError: unsupported operand. NameError: name is not defined. at java.lang.Thread.run. Caused by: java.io.IOException. Fatal error: uncaught exception in index.php. Stack trace follows. Segmentation fault, core dumped.
You have been signed out because your session ended. Please sign in again to go on. Log in to your account to download the full text. Create a free account to keep reading. Buy this article to get the complete text. You must be logged in to view this item.
We are checking that you are a person and not a robot, this takes a few seconds. Complete the captcha to proceed. Please wait while we verify your connection. Your request looks automated and was blocked. One more step before you proceed, solve the puzzle. Security check in progress. Prove that you are human.
This web application needs JavaScript, please switch it on. JavaScript seems to be turned off in the settings of your browser. Without scripts this viewer cannot start; allow scripting for this site, then reload the page. The page works only with scripts enabled. Turn on scripting and reload the page to read the article.
Your browser blocks cookies. Cookies have to be allowed before the text can be displayed. This website uses cookies to improve your experience, click to accept. Please enable cookies and reload the page. Your browser is too old for this site, update it. It looks like you are using an ad blocker, please disable it for this site.
Bitte schalten Sie JavaScript ein, um diese Seite zu sehen. Ihr Browser unterstützt keine Skripte. Diese Seite wurde leider nicht gefunden. Datei nicht gefunden. Die von Ihnen angeforderte Datei ist nicht mehr vorhanden. Diese Adresse existiert leider nicht mehr. Der Zugriff auf dieses Dokument ist nicht erlaubt. Das gewünschte Dokument ist nicht mehr vorhanden. Bitte erlauben Sie Cookies und laden Sie die Seite neu. Es ist ein interner Fehler aufgetreten.
Veuillez autoriser JavaScript pour lire cette page. Fichier introuvable, il a peut-être été déplacé ou retiré. Les scripts sont désactivés dans votre navigateur. La page que vous cherchez n'existe pas ou a été déplacée. L'accès à ce document est interdit. Une erreur interne s'est produite sur le serveur. Acceptez les cookies puis rechargez la page.
Debe activar JavaScript para ver esta página. Su navegador tiene desactivados los scripts. La página que busca no existe o fue movida. No tiene permiso para acceder a este documento. Se produjo un error en el servidor. No se puede mostrar el archivo. No fue posible abrir el fichero pedido (código de error 12). Documento no encontrado. Acepte las cookies y recargue la página.
É preciso ativar o JavaScript para ler esta página. O seu navegador bloqueia scripts. A página que procura não existe ou foi movida. Não tem permissão para abrir este documento. Não foi possível abrir o ficheiro pedido (código de erro 12). Ocorreu um erro no servidor. Aceite os cookies e recarregue a página.
Для просмотра страницы нужен JavaScript, включите его в настройках браузера. Такой страницы не существует или она удалена. У вас нет доступа к этому документу. Не удалось открыть файл (код ошибки 12). Запись не найдена. На сервере произошла ошибка. Разрешите cookies и обновите страницу.
Schakel JavaScript in om deze pagina te bekijken. De pagina is niet gevonden. Attiva JavaScript nel browser per leggere questa pagina. La pagina richiesta non esiste.
Home. Menu. Search. Login. Contact us. Imprint. Sitemap. Skip to navigation. Go to the start page. Privacy. Terms. Share. Print. Help. About us. Sign up. Next page. Previous page. Copyright by the operator of this site.
"""
#: Prose of any subject, also about the web: it stands beside the corpus, whose subject may be narrow.
PROSE = """
The committee met in spring and agreed on a plan for the coming years, which was published the following week. Nobody expected that prices would fall so quickly, but by autumn most farmers had sold their stock.
We counted how often visitors met a broken link and how long the servers needed to answer; the share was small. The study asks why many pages vanish from the web within a few years and what libraries can do about it.
In this chapter we describe the design of the questionnaire and the people who answered it. Children who slept longer did better in the tests, although the difference was not large in every group.
The river rises in the mountains and crosses two plains before it reaches the sea. Its water is used for fields, for mills and, since the last century, for making power.
Security checks at the gate were slow, so that the queue grew during the morning. Engineers replaced the old pump and measured the pressure for a month. She wrote her first novel at the age of thirty, and it was read all over the country.
Treatment with the drug lowered the temperature of patients within two days, and few of them reported side effects. The proof uses induction on the number of vertices and a lemma from an earlier paper.
Die Stadt wurde im zwölften Jahrhundert gegründet und war lange von Mauern umgeben. Viele Leser fragten, weshalb die Preise stiegen, obwohl die Ernte gut war. Wir haben drei Verfahren verglichen und ihre Kosten geschätzt.
Le village se trouve au bord d'un lac que les habitants traversent en bateau. Les auteurs expliquent pourquoi la récolte a baissé et comment les prix ont changé depuis.
La ciudad creció alrededor de un puerto que ya no se usa. Los autores comparan tres métodos y explican por qué el segundo es más barato.
A cidade cresceu junto ao rio e vive hoje do turismo. Os autores comparam três métodos e explicam por que o segundo custa menos.
Город стоит на берегу реки и известен своим рынком. Авторы сравнивают три способа и объясняют, почему второй дешевле.
"""
#: What sentences about notation say, as opposed to sentences in which a field was left unfilled.
ABOUT = """
In the template the variable stands for the name of the user. The engine replaces every mark such as this before the page is rendered. A placeholder is written between two braces. The tag opens an element and is closed by another.
In the shell script the variable holds the path of the file. The macro expands to the current value. The parser reads the string and returns a list of tokens. The symbol denotes the set of all values. The token marks the end of a sequence.
The notation is used for the index of an array. Here the set consists of all numbers above three. In the configuration file the key is given in capital letters. The regular expression matches any digit. The format string takes two arguments.
The character is escaped by a backslash. The syntax of the language allows nested expressions. The command prints the value of the parameter. The term is written as shown in the manual. Set the environment variable to change the rate. The word in brackets is a marker for the reader.
Template languages fill such fields at run time. The code defines a constant called so. The function returns the element at this position. The operator is the quotation of the literal string. The sentence begins with the start symbol of the vocabulary and ends with its stop symbol.
"""
# Delimiters of fields, what stands for a missing value, and names of fields.
DELIMITERS = ("{{%}}", "{{ % }}", "{%}", "${%}", "#{%}", "<%>", "<<%>>", "<%= % %>".replace("= % ", "= # "), "<% # %>", "{% # %}", "[%]", "[[%]]", "[[ % ]]", "%%#%%", "%(#)s", "@@%@@", "__%__", "$%$", "[... % ...]", "[...%...]")
MISSING = ("TODO", "TODO:", "TBD", "TBC", "TBA", "FIXME", "[TBD]", "[TODO]", "(TBD)", "XX", "XXX", "XXXX", "XXXXX", "XXXX-XXXX", "(XXXX)", "??", "???", "????", "????-??-??", "??/??/????", "YYYY", "(YYYY)", "YYYY-MM-DD", "DD/MM/YYYY", "MM/DD/YYYY", "DD.MM.YYYY", "HH:MM", "NN", "NNN", "###", "%s", "%d", "{0}", "{1}", "{2}", "{}", "[XXX]", "[ ]")
FIELDS = tuple("title subtitle author name first_name last_name full_name email address phone date start_date end_date year month day time place city country company position department institution journal volume issue page pages number doi isbn url link abstract text body section chapter heading paragraph content keywords figure caption table image photo reference citation editor publisher version status id key value field label description summary note comment subject message signature user order_number amount price product item recipient sender reason details website logo footer header".split())
NATURAL = tuple("[1] [12] [3,4] [5-7] [i] [n+1] [0,1] {1,2} {a,b} <b> </b> <i> </i> <sub> </sup> <p> <s> <em> [sic] [Fig.] DNA RNA PCR USA (USA) NASA (WHO) HTTP CPU GPS: UTC ISO SEM XRD NMR II III IV VII $x$ $n$".split()) + ("[see Fig. 3]", "{x | x > 0}", "[emphasis added]", "[in press]", "[1, 2]", "< 0.05 and p >", "<|endoftext|>", "<unk>", "<pad>", "[CLS]", "[SEP]", "<mask>")
LEADS = ("", "", "", "your ", "insert ", "enter ", "add ", "the ")


# --- windows and n-grams of a batch ------------------------------------------------------------------------------------------

_LOWER = np.array([ord(chr(i).lower()) if len(chr(i).lower()) == 1 else i for i in range(0x10000)], np.uint64)
_LOWER[0x30:0x3A] = 0x39  # digits are alike
# What a code point is, in bits.
_WORD, _SPACE, _STOP = 1, 2, 4
_KINDS = np.array([_WORD * chr(i).isalnum() + _SPACE * chr(i).isspace() + _STOP * (chr(i) in ".!?…。") for i in range(0x10000)], np.uint8)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _look(table: np.ndarray, x: np.ndarray, beyond) -> np.ndarray:
    out = table.take(x, mode="clip")
    if len(x) and x.max() >= 0x10000:
        out = np.where(x < 0x10000, out, beyond)
    return out


def _kinds(x: np.ndarray) -> np.ndarray:
    return _look(_KINDS, x, np.uint8(_WORD))


def window_starts(x: np.ndarray, width: int, kinds: np.ndarray | None = None) -> np.ndarray:
    """Where the windows of the code points ``x`` begin: sentences and lines, long ones in pieces of about ``width``."""
    kinds = _kinds(x) if kinds is None else kinds
    ends = x == 10
    # A window begins behind a line end, and with the white space behind a full stop.
    ends[:-1] |= ((kinds[:-1] & _STOP) > 0) & ((kinds[1:] & _SPACE) > 0)
    ends[-1:] |= (kinds[-1:] & _STOP) > 0
    cut = np.flatnonzero(ends) + 1
    starts = np.concatenate([[0], cut[cut < len(x)]]) if len(x) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(x)))
    n = np.maximum(1, np.round(sizes / width)).astype(np.int64)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(starts, n) + np.repeat(sizes, n) * k // np.repeat(n, n)


def grams(x: np.ndarray, starts: np.ndarray, plan: ResiduePlan) -> np.ndarray:
    """The bucket of the n-gram that ends at each code point; what stands before a window counts as blanks."""
    last = plan.order - 1
    c = np.concatenate([np.full(last, 33, np.uint64), _look(_LOWER, x, x) + np.uint64(1)])
    h = _chain([c[last - back : len(c) - back] for back in range(last, -1, -1)])
    sizes = np.diff(np.append(starts, len(x)))
    for since in range(last):
        at = starts[sizes > since] + since
        h[at] = _chain([c[at + last - back] if back <= since else np.full(len(at), 33, np.uint64) for back in range(last, -1, -1)])
    return (h & np.uint64(plan.buckets - 1) if not plan.buckets & (plan.buckets - 1) else h % np.uint64(plan.buckets)).view(np.int64)


def _chain(codes: list[np.ndarray]) -> np.ndarray:
    """The hash of a sequence of code points (plus 1), the first of which is its own hash."""
    h = codes[0].copy()
    for c in codes[1:]:
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += c
        h ^= h >> np.uint64(29)
    return h


def _count(texts: list[str], plan: ResiduePlan, out: np.ndarray | None = None) -> np.ndarray:
    """How often each n-gram occurs in ``texts`` and the line ends behind them, added to ``out``: the sum of the counts of each."""
    out = np.zeros(plan.buckets, np.int64) if out is None else out
    for _, parts in _slices(texts, ""):
        x = _codes("".join(t if t.endswith("\n") else t + "\n" for t in parts))
        np.add.at(out, grams(x, window_starts(x, 10_000), plan), 1)
    return out


def _ratio(yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    p = lambda c: 0.999 * c / max(1.0, float(c.sum())) + 1e-7
    return (np.log(p(yes)) - np.log(p(no))).astype(np.float32)


def mash(seed: int, letters: int = 60_000) -> str:
    """Text as from fingers on the middle row of the keyboard."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("asdfghjkl", k=rng.randint(3, 9))) for _ in range(letters // 6))


def _title_end(text: str) -> int:
    """Where the body begins: behind a first paragraph of one line without a full stop that a blank line follows."""
    if "\n" not in text:
        return 0
    m = re.match(r"\s*([^\n]{4,200}?[^\n.!?…\s])[ \t]*\n[ \t]*\n(?=\s*\S)", text)
    return m.end() if m else 0


def _all_starts(x: np.ndarray, firsts: np.ndarray, bodies: np.ndarray, plan: ResiduePlan, kinds: np.ndarray | None = None) -> np.ndarray:
    """Where the windows of joined texts begin: a text and a body begin one, too."""
    begins = np.zeros(len(x) + 1, bool)
    for at in (window_starts(x, plan.window, kinds), firsts, bodies):
        begins[at] = True
    return np.flatnonzero(begins[: len(x)])


def _window_sums(texts: list[str], ratios: np.ndarray, plan: ResiduePlan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, weight, sums of the columns of ``ratios``) of the windows of ``texts``, all in one pass. The weight of a window is its
    number of characters that are no white space; of one without a word, or in a title, it is 0."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.cumsum(lengths + 1) - lengths - 1
    body = firsts + np.fromiter(map(_title_end, texts), np.int64, len(texts))
    x = _codes("\n".join(texts))
    kinds = _kinds(x)
    starts = _all_starts(x, firsts[lengths > 0], body, plan, kinds)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, ratios.shape[1]), np.float32)
    found = grams(x, starts, plan)
    sums = np.stack([np.add.reduceat(ratios[:, i].take(found), starts) for i in range(ratios.shape[1])], axis=1)
    # What repeats a character for the fifth time says nothing.
    same = x[1:] == x[:-1]
    repeated = np.zeros(len(x), bool)
    repeated[4:] = same[3:] & same[2:-1] & same[1:-2] & same[:-3]
    inked = np.add.reduceat(~(((kinds & _SPACE) > 0) | repeated), starts, dtype=np.int64)
    word = np.logical_or.reduceat((kinds & _WORD) > 0, starts)
    row = np.searchsorted(firsts, starts, side="right") - 1
    weight = np.where(word, inked, 0)
    weight_body = np.where(starts >= body[row], weight, 0)
    # A text that is all title has no other body.
    alone = np.bincount(row, weight_body, len(texts)) == 0
    return row, np.where(alone[row], weight, weight_body), sums


def score_windows(texts: list[str], ratios: np.ndarray, plan: ResiduePlan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, weight, best score, best class) of the windows of ``texts``."""
    row, weight, sums = _window_sums(texts, ratios, plan)
    return row, weight, sums.max(axis=1), sums.argmax(axis=1)


#: The log likelihood ratio a character that a window needs lies between these; where, held-out prose decides.
LEAST, MOST = -0.5, 0.15


def _is_residue(weight: np.ndarray, score: np.ndarray, limit: float) -> np.ndarray:
    return score > np.maximum(2.0 if limit > 0 else -20.0, limit * weight)


def residue_shares(texts: list[str], models: Models, plan: ResiduePlan) -> np.ndarray:
    """The share of residue windows in the body of each text, by characters. A text of more than ``_SLICE`` characters is scored in
    slices that end with lines, which no window crosses: memory is bounded by the longest line."""
    hit, whole = np.zeros(len(texts)), np.zeros(len(texts))
    for at, parts in _slices(texts):
        row, weight, score, _ = score_windows(parts, models.ratios, plan)
        for out, value in ((hit, weight * _is_residue(weight, score, models.limit)), (whole, weight)):
            np.add.at(out, at, np.bincount(row, value, len(parts)))
    return hit / np.maximum(1, whole)


_SLICE = 1 << 20
#: Characters that are scored at once, if texts are shorter: what numpy works on stays in the caches.
_PIECE = 1 << 17


def _slices(texts: list[str], mark: str = ".\n") -> Iterator[tuple[list[int], list[str]]]:
    """(rows, texts) to be scored at once: all short ones, then the slices of each long one. A slice behind the first begins with
    a full stop of its own (``mark``), so that its first line is no title."""
    short = [i for i, t in enumerate(texts) if len(t) <= _SLICE]
    yield short, [texts[i] for i in short]
    for i, t in enumerate(texts):
        at = 0
        while len(t) > _SLICE and at < len(t):
            end = len(t) if len(t) - at <= _SLICE else t.rfind("\n", at, at + _SLICE) + 1 or t.find("\n", at + _SLICE) + 1 or len(t)
            yield [i], [t[at:end] if not at else mark + t[at:end]]
            at = end


def _window_texts(texts: list[str], plan: ResiduePlan) -> list[str]:
    x = _codes("\n".join(texts))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.cumsum(lengths + 1) - lengths - 1
    starts = _all_starts(x, firsts[lengths > 0], firsts + np.fromiter(map(_title_end, texts), np.int64, len(texts)), plan)
    whole = "\n".join(texts)
    return [whole[a:b].strip("\n") for a, b in zip(starts, [*starts[1:], len(x)] if len(starts) else (), strict=True)]


# --- placeholders -----------------------------------------------------------------------------------------------------------

_INSIDE = r"[^{}\[\]<>\n]{1,60}?"
_SPAN = re.compile(
    rf"\{{\{{{_INSIDE}\}}\}}|[$#]\{{{_INSIDE}\}}|\{{%{_INSIDE}%\}}|\{{[^{{}}\n]{{0,60}}\}}|<%{_INSIDE}%>|<<{_INSIDE}>>|</?{_INSIDE}>|\[\[{_INSIDE}\]\]|\[[^\[\]\n]{{1,60}}\]"
    rf"|%%[^%\n]{{1,60}}%%|%\([^()\n]{{1,60}}\)[a-z]|@@[^@\n]{{1,60}}@@|(?<!\w)__[^\s_][^\n]{{0,58}}?__(?!\w)|(?<!\w)\$[A-Za-z][^$\n\s]{{0,58}}\$|(?<![\w%])%[sd](?!\w)|\(?(?<![^\s(])[A-Z?#_]{{2,}}(?:[-/.:][A-Z?#_]{{1,}})*[:)]?(?![\w])"
)
#: Every span begins where this does.
_BEGIN = re.compile(r"[{\[<$@%(#_?A-Z](?:(?<=[{\[<$@%])|(?<=#)\{|(?<=\()(?=[A-Z?#_]{2})|(?<=[A-Z?#_])[A-Z?#_])")
#: Without any of these there is no candidate.
_ANY_MARK = re.compile(r"[{\[<$#@_]|%[s(%d]|\?\?|[A-Z]{2}")


def _shape(span: str) -> str:
    """A span as the n-gram models see it: bounded, and with a mark where its letters are capitals."""
    return ("\x02" if span.isupper() else "\x01") + span + "\x03"


def _span_examples(seed: int) -> list[str]:
    """Unfilled fields: every delimiter with field names in several ways of writing, and marks of missing values."""
    rng = random.Random(seed)
    out = []
    for d in DELIMITERS:
        for name in FIELDS:
            spaced = name.replace("_", " ")
            written = rng.choice((name, name, spaced, rng.choice(LEADS) + spaced, spaced.title(), spaced.upper(), name.upper(), rng.choice(FIELDS) + " " + spaced, name.replace("_", ".")))
            out.append(d.replace("#", written) if "#" in d[1:-1] else d.replace("%", written))
    return out + list(MISSING) * (len(out) // (2 * len(MISSING)))


@dataclass
class Models:
    """Log likelihood ratios, all of a bounded size: of windows (one column for each residue class), of spans, and of
    sentences about notation."""

    ratios: np.ndarray
    limit: float
    spans: np.ndarray
    about: np.ndarray


def _score_each(pieces: list[str], ratio: np.ndarray, plan: ResiduePlan) -> np.ndarray:
    """The sum of ``ratio`` over each piece."""
    x = _codes("\n".join(pieces))
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(lengths + 1) - lengths - 1
    values = ratio[grams(x, starts, plan)]
    values[starts[1:] - 1] = 0  # the separators
    return np.add.reduceat(values, starts) if len(pieces) else np.zeros(0)


def _told(sentences: list[str], about: np.ndarray, plan: ResiduePlan) -> np.ndarray:
    """Which sentences are about notation; short ones need more a character, as they say little."""
    size = np.fromiter(map(len, sentences), np.int64, len(sentences))
    return _score_each(sentences, about, plan) > np.maximum(8.0, 0.25 * size)


#: What is read of the sentence around a candidate on either side.
_AROUND = 400
_SENTENCE_ENDS = (". ", "! ", "? ", "… ", "\n")


def _spans(text: str) -> Iterator[re.Match[str]]:
    """What ``_SPAN.finditer`` gives."""
    at = 0
    while begin := _BEGIN.search(text, at):
        if m := _SPAN.match(text, begin.start()):
            yield m
        at = m.end() if m else begin.start() + 1


def candidates(text: str) -> list[tuple[str, str, bool]]:
    """(span, its sentence without it, whether it is quoted or one of a pair of tags) for each candidate of a text."""
    out = []
    for m in _spans(text):
        if not out and not _ANY_MARK.search(text):
            return []
        a, b = m.start(), m.end()
        low, high = max(0, a - _AROUND), min(len(text), b + _AROUND)
        start = max([x + len(stop) for stop in _SENTENCE_ENDS if (x := text.rfind(stop, low, a)) >= 0], default=low)
        ends = [x for stop in _SENTENCE_ENDS if (x := text.find(stop, b, high)) >= 0]
        sentence = text[start:a] + " " + text[b : min(ends, default=high)]
        quoted = a > 0 and b < len(text) and text[a - 1] in "“\"'`‘«" and text[b] in "”\"'`’»"
        tag = m[0][0] == "<" and (m[0][1:2] == "/" or f"</{m[0][1:]}" in text)
        out.append((m[0], sentence, quoted or tag))
    return out


def placeholder_rows(texts: list[str], models: Models, plan: ResiduePlan) -> np.ndarray:
    """Which texts have a field left unfilled, in a sentence that does not talk about such marks."""
    rows, spans, sentences = [], [], []
    for i, text in enumerate(texts):
        for span, sentence, mentioned in candidates(text):
            if not mentioned:
                rows.append(i)
                spans.append(_shape(span))
                sentences.append(sentence)
    out = np.zeros(len(texts), bool)
    if rows:
        hit = np.flatnonzero(_score_each(spans, models.spans, plan) > 0)
        if len(hit):
            told = _told([sentences[i] for i in hit], models.about, plan)
            out[[rows[i] for i, t in zip(hit, told, strict=True) if not t]] = True
    return out


# --- fitting ------------------------------------------------------------------------------------------------------------------

#: Documents with a share of residue below this are prose.
_PROSE_SHARE = 0.4
#: The limit is found to a thousandth: scores a character are counted between these, in thousandths.
_LOWEST, _HIGHEST = -1001, -349


@dataclass
class _Known:
    """What one round knows: log likelihood ratios of the residue classes, and the limit."""

    ratios: np.ndarray
    limit: float


def _held_out(text: str) -> bool:
    """Whether a text is of the half that is judged by models of the other half."""
    return bool(zlib.crc32(text.encode("utf-8", "surrogatepass")) & 1)


# Steps add what they count in some rows to the rows of ``out``, whole numbers: their order does not matter.


def _count_halves(out: np.ndarray, texts: list[str], plan: ResiduePlan) -> None:
    """n-grams of the held-out half and of the other, and in a last row the number of texts."""
    held = [_held_out(t) for t in texts]
    for i in (0, 1):
        _count([t for t, h in zip(texts, held, strict=True) if h != bool(i)], plan, out[i])
    out[2, 0] += len(texts)


def _count_scores(out: np.ndarray, texts: list[str], ratios: np.ndarray, n: int, limit: float | None, plan: ResiduePlan) -> None:
    """How many long windows of held-out prose have each score a character by the first ``n`` columns of ``ratios``. Prose is what
    the other columns and ``limit`` say, everything without a limit."""
    texts = [t for t in texts if _held_out(t)]
    hit, whole, rows, steps = np.zeros(len(texts)), np.zeros(len(texts)), [], []
    for at, parts in _slices(texts):
        row, weight, sums = _window_sums(parts, ratios, plan)
        row = np.asarray(at, np.int64)[row]
        if limit is not None:
            hit += np.bincount(row, weight * _is_residue(weight, sums[:, n:].max(axis=1), limit), len(texts))
            whole += np.bincount(row, weight, len(texts))
        long = weight >= 20
        rows.append(row[long])
        steps.append(np.floor(1000 * sums[long, :n].max(axis=1).astype(np.float64) / weight[long]))
    prose = hit / np.maximum(1, whole) < _PROSE_SHARE
    kept = np.concatenate(steps)[prose[np.concatenate(rows)]]
    out[0] += np.bincount(np.clip(kept, _LOWEST, _HIGHEST).astype(np.int64) - _LOWEST, minlength=out.shape[1])


def _limit(counts: np.ndarray) -> float:
    """What 99 of 100 windows of prose stay below, with some room: one half of the corpus is judged by models of the other."""
    if counts.sum() < 100:
        return MOST
    step = int(np.searchsorted(np.cumsum(counts), 0.99 * counts.sum())) + _LOWEST + 1
    return float(np.clip(step / 1000 + 0.5, LEAST, MOST))


def _covered(out: np.ndarray, texts: list[str], known: _Known, plan: ResiduePlan) -> list[str]:
    """Texts that are not prose: what ``_count_learned`` is to see."""
    return [t for t, s in zip(texts, residue_shares(texts, known, plan), strict=True) if s >= _PROSE_SHARE]


def _count_learned(out: np.ndarray, texts: list[str], known: _Known, plan: ResiduePlan) -> None:
    """n-grams of the windows of each residue class in documents that residue covers; then ``_count_halves`` of those that are
    not prose."""
    share = residue_shares(texts, known, plan)
    classes = known.ratios.shape[1]
    learn = [t for t, s in zip(texts, share, strict=True) if s >= plan.learn]
    for _, parts in _slices(learn):
        row, weight, _, kind = score_windows(parts, known.ratios, plan)
        windows = _window_texts(parts, plan)
        for i in range(classes):  # all windows of such a document, those not yet known too
            _count([w for w, t in zip(windows, (weight > 0) & (kind == i), strict=True) if t], plan, out[i])
    _count_halves(out[classes:], [t for t, s in zip(texts, share, strict=True) if s >= _PROSE_SHARE], plan)


def _spans_told(texts: list[str], about: np.ndarray, known: _Known | None, plan: ResiduePlan) -> list[tuple[str, bool]]:
    """(span, whether it is talked about) of the candidates of prose."""
    each = [(t, c) for t in texts if (c := candidates(t))]
    if known is not None and each:
        share = residue_shares([t for t, _ in each], known, plan)
        each = [x for x, s in zip(each, share, strict=True) if s < _PROSE_SHARE]
    found = [c for _, some in each for c in some]
    told = _told([c[1] for c in found], about, plan) if found else []
    return [(c[0], bool(c[2] or t)) for c, t in zip(found, told, strict=True)]


def _count_shapes(out: np.ndarray, spans: list[str], times: list[int], plan: ResiduePlan) -> None:
    """``_count`` of the shapes of spans of which each occurs several times."""
    x = _codes("".join(_shape(s) + "\n" for s in spans))
    sizes = np.fromiter((len(s) + 3 for s in spans), np.int64, len(spans))
    np.add.at(out[0], grams(x, window_starts(x, 10_000), plan), np.repeat(np.asarray(times, np.int64), sizes))


def _natural(span: str) -> bool:
    """Natural are those without a word, and words in capitals of several letters; the others are either unfilled fields, which
    join the made ones unless they are talked about, or left out."""
    return span not in MISSING and (not re.search(r"[^\W\d_]{2}", span) or (span.isalpha() and len(set(span)) > 2))


def _count_natural(out: np.ndarray, spans: list[str], told: list[bool], times: list[int], plan: ResiduePlan) -> None:
    kept = [(s, n) for s, n in zip(spans, times, strict=True) if _natural(s)]
    _count_shapes(out, [s for s, _ in kept], [n for _, n in kept], plan)


def _count_fields(out: np.ndarray, spans: list[str], told: list[bool], times: list[int], ratio: np.ndarray, plan: ResiduePlan) -> None:
    field = _score_each([_shape(s) for s in spans], ratio, plan) > 0
    kept = [(s, n) for s, n, t, f in zip(spans, times, told, field, strict=True) if f and not t]
    _count_shapes(out, [s for s, _ in kept], [n for _, n in kept], plan)


def _add_up(out: np.ndarray, pieces: Iterator[list[list]], step: Callable[..., list[str] | None], then: Callable[..., None] | None) -> None:
    """Adds to ``out`` what ``step`` counts in each piece, and what ``then`` counts in the texts that it returns, many at once."""
    waiting, size = [], 0
    for columns in pieces:
        kept = step(out, *columns) or []
        waiting += kept
        size += sum(map(len, kept))
        if size > _PIECE:
            then(out, waiting)
            waiting, size = [], 0
    if waiting:
        then(out, waiting)


@dataclass
class _Listed:
    """Columns of texts, or of spans, in memory."""

    columns: list[list]

    def tally(self, shape: tuple[int, int], step: Callable[..., list[str] | None], then: Callable[..., None] | None = None) -> np.ndarray:
        """The sum of what ``step`` and ``then`` count, over all rows."""
        out = np.zeros(shape, np.int64)
        _add_up(out, ([c[i : i + 150] for c in self.columns] for i in range(0, len(self.columns[0]), 150)), step, then)
        return out

    def spans(self, step: Callable[[list[str]], list[tuple[str, bool]]]) -> _Listed:
        found = Counter(step(self.columns[0]))
        return _Listed([[s for s, _ in found], [t for _, t in found], list(found.values())])


@dataclass
class _Tabled:
    """The same of a table, the first column of which are strings: sums come to the driver, rows never do."""

    rows: DataFrame

    def tally(self, shape: tuple[int, int], step: Callable[..., list[str] | None], then: Callable[..., None] | None = None) -> np.ndarray:
        name = self.rows.columns[0]
        shared = self.rows.sparkSession.sparkContext.broadcast((step, then))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape, np.int64)
            _add_up(out, ([c.to_pylist() for c in part.columns] for batch in batches for part in _pieces(batch, name=name)), *shared.value)
            kind, at = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(out[kind, at], pa.int64())], names=["kind", "at", "n"])

        sums = self.rows.mapInArrow(run, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
        shared.destroy()
        total = np.zeros(shape, np.int64)
        total[sums["kind"].to_numpy(), sums["at"].to_numpy()] = sums["n"].to_numpy()
        return total

    def spans(self, step: Callable[[list[str]], list[tuple[str, bool]]]) -> _Tabled:
        name = self.rows.columns[0]
        shared = self.rows.sparkSession.sparkContext.broadcast(step)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _pieces(batch, name=name):
                    found = shared.value(part.column(0).to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.string()), pa.array([t for _, t in found], pa.bool_())], names=["span", "told"])

        return _Tabled(checkpointed(self.rows.mapInArrow(run, "span string, told boolean").groupBy("span", "told").agg(F.count("*").alias("n"))))


def fit(texts: list[str], plan: ResiduePlan) -> Models:
    """The models, fitted on general examples and on all of ``texts``."""
    return _fit(_Listed([texts]), plan)


def _fit(corpus: _Listed | _Tabled, plan: ResiduePlan) -> Models:
    lines = lambda s: [x for x in s.strip().split("\n")]
    seeds = [_count(lines(FILLER), plan), _count(lines(NOTICES), plan), _count([mash(plan.seed)], plan)]
    general = _count(lines(PROSE), plan)
    everything = corpus.tally((3, plan.buckets), partial(_count_halves, plan=plan))
    prose, learned, known = everything, [np.zeros(plan.buckets, np.int64) for _ in seeds], None
    for turn in range(plan.rounds + 1):
        # What was learned counts at most as much as the general examples.
        classes = [seed + more * min(1.0, float(seed.sum()) / max(1.0, float(more.sum()))) for seed, more in zip(seeds, learned, strict=True)]
        # General prose counts as three tenths of the corpus.
        against = prose[0] + prose[1] + general * max(1.0, 0.3 * float(prose[:2].sum()) / float(general.sum()))
        ratios = np.asfortranarray(np.stack([_ratio(c, against) for c in classes], axis=1))
        limit = MOST
        if everything[2, 0]:
            both = [_ratio(c, prose[1]) for c in classes] + ([*known.ratios.T] if known else [])
            step = partial(_count_scores, ratios=np.asfortranarray(np.stack(both, axis=1)), n=len(classes), limit=known and known.limit, plan=plan)
            limit = _limit(corpus.tally((1, _HIGHEST - _LOWEST + 1), step)[0])
        if turn == plan.rounds or not everything[2, 0]:
            break
        known = _Known(ratios, limit)
        counted = corpus.tally((len(seeds) + 3, plan.buckets), partial(_covered, known=known, plan=plan), partial(_count_learned, known=known, plan=plan))
        learned, prose = counted[: len(seeds)], everything - counted[len(seeds) :]
        if not prose[2, 0]:
            prose, known = everything, None

    # Spans: the candidates of the corpus are natural unless they look like unfilled fields and nothing says that they are meant.
    made = _count([_shape(x) for x in _span_examples(plan.seed)], plan)
    about = _ratio(_count(lines(ABOUT), plan), prose[0] + prose[1])
    models = Models(ratios, limit, np.zeros(plan.buckets, np.float32), about)
    more, natural = np.zeros((2, plan.buckets), np.int64)
    natural += _count([_shape(x) for x in NATURAL], plan)
    if everything[2, 0]:
        found = corpus.spans(partial(_spans_told, about=about, known=known, plan=plan))
        natural += found.tally((1, plan.buckets), partial(_count_natural, plan=plan))[0]
    for turn in range(plan.rounds):
        models.spans = _ratio(made + more * min(1.0, float(made.sum()) / max(1.0, float(more.sum()))), natural)
        if turn == plan.rounds - 1 or not everything[2, 0]:
            break
        more = found.tally((1, plan.buckets), partial(_count_fields, ratio=models.spans, plan=plan))[0]
    return models


# --- operator -----------------------------------------------------------------------------------------------------------------


def find_residue(documents: DataFrame, plan: ResiduePlan | None = None) -> DataFrame:
    """(doc_id, why, share) of the documents to exclude: ``why`` is placeholder or residue, ``share`` that of residue.

    Null, empty and blank texts are not residue; repeated rows each give their row; an empty table gives an empty result. The
    models are fitted on every document: ``documents`` is read 2 x ``rounds`` + 3 times for them, and once for the result.
    """
    plan = plan or ResiduePlan()
    texts = documents.select("doc_id", "text").filter(F.col("text").rlike(r"\S"))
    shared = documents.sparkSession.sparkContext.broadcast(_fit(_Tabled(texts.select("text")), plan))  # 5 x buckets floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            for part in _pieces(batch):
                texts = part.column("text").to_pylist()
                share = residue_shares(texts, models, plan)
                hole = placeholder_rows(texts, models, plan)
                keep = np.flatnonzero(hole | (share >= plan.coverage))
                why = ["placeholder" if hole[i] else "residue" for i in keep]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), pa.array(why, pa.string()), pa.array(share[keep], pa.float64())], names=["doc_id", "why", "share"])

    return texts.mapInArrow(run, "doc_id long, why string, share double")


def _pieces(batch: pa.RecordBatch, most: int = _PIECE, name: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` characters of text, of one row at least: what is scored at once stays small."""
    sizes = pc.utf8_length(batch.column(name)).to_pylist()
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if batch.num_rows > at:
        yield batch.slice(at)
