"""Defective answers in pairs of a text and a model's answer to it (problem 1).

Method: a linear-chain conditional random field tags the clauses of a response as answer, refusal, echo, foreign or unfinished;
the shares of the clauses give the defect of the pair. Responses without substance are empty and need no tags.

The field is trained here, on a bounded sample of the corpus (``sample_pairs``). Its labelled rows are made from it: responses
as they are (answers), cut or left hanging (unfinished), sentences of the text with small changes (echo), sentences of texts
in other languages (foreign), and refusals put together from general phrases. As some responses of the sample are defective
themselves, each half of them is judged by a field that has not seen it: what is likely defective is left out of the answers,
and what is surely a refusal is learned as one, so that the field knows how this corpus refuses.

What tells an unfinished phrase is how words end responses all over the corpus: the number of times each word stands, and
stands last, is counted over all responses, and so is the most frequent longer word that begins with it.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import bounded_sample, checkpointed

LABELS = ("answer", "refusal", "echo", "foreign", "unfinished")
DEFECTS = {"refusal": "refusal", "echo": "copy", "foreign": "language", "unfinished": "truncated"}


@dataclass(frozen=True)
class PairPlan:
    """``sample_pairs`` pairs at most are used to train. Statistics of the ``most_words`` most frequent last words are
    broadcast, those of rarer ones, if there are more, are joined. ``steps``
    are those of the fit, ``prior`` is the strength with which weights are held to zero."""

    sample_pairs: int = 4000
    most_words: int = 300_000
    steps: int = 60
    prior: float = 1.0
    seed: int = 3


# Responses that say nothing, words that cannot end a phrase, words that tell a language, phrases of refusals.
NOTHING = frozenset("n a|na|none|null|nil|empty|no answer|no response|no summary|not available|not applicable|unknown|tbd|todo|nan|undefined|blank|summary|answer|response|result|output|text|abstract|excerpt|the summary|here is the summary|here is a summary|in summary".split("|"))
HANGING = frozenset("a an and as at because between both but by for from if in into is its nor of on or our over per such than that the their this to under upon via was were when where whether which while whose with within without are be been has have had can could may might must should will would only also e.g i.e cf vs approx ca app fig see".split())
STOP = {
    "en": "the of and to in is by with for at on from not no was were this that be are an or as it its than but has have only only under than when which while shown set cannot".split(),
    "other": "die der das den dem des ein eine einer und ist nicht mit von zu für auf im bei nach trotz während le la les des du un une et est dans pour par sur au aux ne pas el los las del una y es en con por para o os da do em uma não na no sem após que se malgré pendant après durante según".split(),
}
# General phrases from which refusals are put together; none of the longer ones is taken from a table.
_REFUSE = {
    "open": ["I'm sorry, but ", "I am sorry, ", "Sorry, ", "Sorry – ", "Unfortunately ", "Regrettably, ", "I regret that ", "My apologies, ", "I apologise, but ", "Thanks for your message, but ", "Thank you, however ", "I understand, still ", "As a language model ", "As an AI, ", "As an assistant ", "Hmm, ", "Well, ", "I'm afraid ", "", "", "", ""],
    "deny": ["I can't ", "I cannot ", "I can not ", "I won't ", "I will not ", "I am not able to ", "I'm not able to ", "I'm unable to ", "I am unable to ", "I won't be able to ", "I would rather not ", "I'd prefer not to ", "I must refuse to ", "I have to refuse to ", "I must decline to ", "I decline to ", "I'm not allowed to ", "I am not permitted to ", "I don't want to ", "I couldn't ", "I do not know how to ", "it isn't possible for me to ", "there is no way for me to "],
    "act": ["help with your request", "help you here", "help with this", "assist with the task", "assist you further", "do what you ask", "do that", "carry out this instruction", "answer your question", "answer this", "comply", "comply with these instructions", "continue", "go on with this topic", "sum up this document", "summarise your file", "summarize anything here", "condense the {n}", "shorten this {n}", "sum up your {n}", "summarise the given {n}", "write up the {n}", "treat this {n}", "write a summary of the {n}", "write an outline", "write about {x}", "give you a summary", "provide an overview of {x}", "produce an abstract of the {x} part", "discuss the {x} matter", "read your attachment", "read the file on {x}", "open the document", "access the {x} paper", "process this {n}", "work on the {n}", "describe this {n}"],
    "tail": [".", ".", ".", ".", "!", " right now.", " today.", " here.", " in this form.", " without further details.", " without seeing it.", " unless you send the text.", " because I have no access to it.", " because nothing was attached.", ", as it might be unsafe.", ", as it may be private.", ", since it could be under copyright.", ", since this is against my rules.", "; the input is empty.", "; there was nothing to read.", ". Please send the text again.", ". Please upload the whole {n}.", ". Please choose a different {n}.", ". Can you share the section?", ". Could you try with another one?", ". Maybe ask a librarian."],
    "noun": ["text", "text", "passage", "excerpt", "section", "paragraph", "document", "material", "article", "content", "file", "pages"],
    "whole": ["The {n} you gave me is too short, please send more of it.", "Your {n} holds too little for me to use.", "No overview can be made by this assistant from the given {n}.", "Please send me the text that you want summarised.", "Please paste the {n} you would like me to shorten.", "Could you provide the document? I only see an empty message.", "Can you give me the section on {x}? I do not see it.", "I see no text here, so there is nothing I can summarise.", "There is nothing here for me to read. Send the material on {x} first.", "I have no access to your files, so please copy the content into the chat.", "It looks as if the attachment is missing. Upload it again, please.", "You did not include any text on {x}. Include it and I will write a summary.", "My rules forbid me to treat this subject.", "This goes beyond what I am allowed to do.", "This request conflicts with my rules.", "Talking about {x} is not something I may do.", "Material on {x} lies outside of what I am able to treat.", "No answer can be given by me to this request.", "Without the original text no summary is possible; please provide it.", "The message contains instructions that I must not follow.", "As a language model I have no way to open this file.", "I was not given any material to condense.", "Nothing was supplied, so nothing can be summarised by me."],
}
_DANGLE = [" and", " of", " with a", " with the", " for the", " in the", " because of", " as well as", " which", " while", " but only if the", " than", " under the", " (", " (see", " –", "; and", " by", " to", " the", " on", ",", ",", ",", " –", " –", " (n=", " from", ":", " due to the", " such as"]
_LEAD = ["", "", "Summary: ", "Answer: ", "Excerpt: ", "The authors write: ", "The text says: ", "Here is the passage: ", "Text: "]

_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d[\d.,]*|[%°]")
_CLAUSE = re.compile(r"(?:(?<=[.;!?…])|(?<=[^\d\s]:)|(?<=[.!?]['\"”»)]))\s+|\s[–—]\s|\n\s*\n+|\n(?=[-*•])")
_ABBREVIATION = re.compile(r"\b(?:approx|app|ca|cf|e\.g|i\.e|vs|fig|no|resp|al)\.$", re.IGNORECASE)


def norm_words(text: str) -> list[str]:
    """Words in lower case, numbers as 9."""
    return ["9" if w[0].isdigit() else w for w in _WORDS.findall(text.lower())]


def clauses(response: str) -> list[str]:
    out: list[str] = []
    for part in _CLAUSE.split(response):
        if not part or not part.strip():
            continue
        if out and _ABBREVIATION.search(out[-1]):
            out[-1] += " " + part.strip()
        else:
            out.append(part.strip())
    return out


def is_empty(response: str | None) -> bool:
    """Null, or nothing of substance: no letter or digit, or words that only stand for an answer."""
    if response is None:
        return True
    plain = " ".join(re.findall(r"[^\W_]+", response.lower()))
    return not plain or plain in NOTHING


# --- features ------------------------------------------------------------------------------------------------------------------


def _grams(words: list[str]) -> set[tuple[str, str, str]]:
    return set(zip(words, words[1:], words[2:], strict=False))


_STOP_EN, _STOP_OTHER = frozenset(STOP["en"]), frozenset(STOP["other"])


def _plain(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)) if not s.isascii() else s


class Languages:
    """Log likelihood ratio of English against other languages by letter triples, marks left out."""

    def __init__(self, english: list[str], other: list[str]) -> None:
        counts = [Counter(), Counter()]
        for c, texts in zip(counts, (english, other), strict=True):
            for t in texts:
                low = f" {_plain(t.lower())} "
                c.update(low[i : i + 3] for i in range(len(low) - 2))
        n = [sum(c.values()) + 1 for c in counts]
        self.ratio = {g: float(np.log((counts[0][g] + 0.5) / n[0]) - np.log((counts[1][g] + 0.5) / n[1])) for g in counts[0].keys() | counts[1].keys()}

    def score(self, text: str) -> float:
        low = f" {_plain(text.lower())} "
        get = self.ratio.get
        return sum(get(low[i : i + 3], 0.0) for i in range(len(low) - 2)) / max(1, len(low) - 2)


def _bucket(x: float, edges: tuple[float, ...]) -> int:
    return sum(x >= e for e in edges)


def clause_features(response: str, text: str, ending: tuple[float, float, float], languages: Languages) -> tuple[list[str], list[list[str]]]:
    """(clauses, names of the features of each). ``ending``: how the last word is used, as ``usage`` gives it."""
    parts = clauses(response)
    whole = norm_words(text)
    known, known_words = _grams(whole), set(whole)
    out = []
    for i, part in enumerate(parts):
        ws = norm_words(part)
        n = len(ws)
        f = ["bias", f"n{min(n, 6) if n < 6 else 6 + (n > 12)}"]
        last = i == len(parts) - 1
        if len(parts) == 1:
            f.append("alone")
        elif i == 0:
            f.append("first")
        elif last:
            f.append("last")
        grams = _grams(ws)
        if grams:
            share = len(grams & known) / len(grams)
        else:
            share = float(bool(ws) and all(w in known_words for w in ws)) * 0.6
        f.append(f"echo{_bucket(share, (0.01, 0.3, 0.5, 0.7, 0.85, 0.999))}{'L' if n >= 6 else 'M' if n >= 4 else 'S'}")
        en, other = sum(w in _STOP_EN for w in ws), sum(w in _STOP_OTHER and w not in _STOP_EN for w in ws)
        f.append(f"stop{min(en, 2)}{min(other, 3)}")
        letters = [c for c in part if c.isalpha()]
        if letters:
            strange = sum(c > "ɏ" for c in letters) / len(letters)
            f.append(f"strange{_bucket(strange, (0.05, 0.3, 0.7))}")
            f.append(f"lang{_bucket(languages.score(part), (-1.5, -0.8, -0.3, 0.3, 0.8, 1.5))}{'S' if n < 4 else 'L'}")
        f += [f"w:{w}" for w in ws]
        f += [f"w:{a} {b}" for a, b in zip(["<", *ws], [*ws, ">"], strict=True)]
        if last:
            f += ending_features(part, ws, ending)
        out.append(f)
    return parts, out


def usage(count: int, final: int, longer: int, total: int) -> tuple[float, float, float]:
    """Of a word: the share of its uses that end a response, how many times as frequent its most frequent extension is, and
    the share of all responses that it ends."""
    return final / max(1, count), longer / max(1, count), final / max(1, total)


def ending_features(part: str, ws: list[str], ending: tuple[float, float, float]) -> list[str]:
    ends, longer, common = ending
    if ws and len(ws[-1]) < 2:  # the end of a unit ("g/L"), not of a word cut short
        longer = 0
    end = part.rstrip("\"'”»’")[-1:]
    stop = end in ".!?…" and not _ABBREVIATION.search(part)
    f = ["stop" if stop else "open"]
    if not stop:
        word = ws[-1] if ws else ""
        usual = 0 if word in HANGING else _bucket(common, (0.001, 0.004))
        f.append(f"ends{_bucket(ends, (0.002, 0.01, 0.03, 0.08, 0.2))}")
        f.append(f"longer{_bucket(longer, (2, 8, 30))}")
        f += [f"usual{usual}", f"usual{usual} ends{_bucket(ends, (0.01, 0.08))} longer{_bucket(longer, (2, 8))}"]
    # The surest signs are features of several names, so that fewer steps teach them a high weight.
        if word in HANGING:
            f += ["hanging", "hanging again"]
        if end in "–—-,;:(=/":
            f += ["mark", "mark again", f"mark {end}"]
        if part.count("(") > part.count(")"):
            f.append("paren")
        if word == "9" and end.isdigit():
            f.append("number")
    return f


# --- the field -------------------------------------------------------------------------------------------------------------------


class Field:
    """A linear-chain conditional random field: weights of features by label, and of neighbouring labels."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray) -> None:
        self.names, self.weights, self.moves = names, weights, moves

    def potentials(self, features: list[list[str]]) -> np.ndarray:
        get = self.names.get
        return np.stack([self.weights[[k for x in f if (k := get(x)) is not None]].sum(0) for f in features])

    def marginals(self, features: list[list[str]]) -> np.ndarray:
        """The probability of each label for each clause."""
        return _chain(self.potentials(features), self.moves)[0]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def _chain(p: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label marginals, expected label pairs) of one sequence, by forward and backward sums."""
    n = len(p)
    if n == 1:
        e = np.exp(p - p.max())
        return e / e.sum(), np.zeros_like(moves)
    a, b = np.empty_like(p), np.zeros_like(p)
    a[0] = p[0]
    for i in range(1, n):
        a[i] = p[i] + _lse(a[i - 1][:, None] + moves, 0)
    for i in range(n - 2, -1, -1):
        b[i] = _lse(moves + (p[i + 1] + b[i + 1])[None, :], 1)
    z = _lse(a[-1], 0)
    pairs = np.zeros_like(moves)
    for i in range(1, n):
        pairs += np.exp(a[i - 1][:, None] + moves + (p[i] + b[i])[None, :] - z)
    return np.exp(a + b - z), pairs


class Rows:
    """Sequences of clauses with their features as arrays; rows of one length stand together. Words are features only if they
    are met in several responses that refuse or may refuse: the topics of answers are not to be learned by heart."""

    def __init__(self, features: list[list[list[str]]], refusing: list[bool]) -> None:
        used = Counter(x for fs, r in zip(features, refusing, strict=True) if r for x in {x for f in fs for x in f if x.startswith("w:")})
        known = sorted({x for fs in features for f in fs for x in f if not x.startswith("w:") or used[x] >= 4})
        self.names = {x: i for i, x in enumerate(known)}
        self.order = np.argsort([len(fs) for fs in features], kind="stable")
        self.size = np.array([len(features[i]) for i in self.order])
        own = [np.array([k for x in f if (k := self.names.get(x)) is not None], np.int64) for i in self.order for f in features[i]]
        self.feature, self.count = np.concatenate(own), np.array([len(f) for f in own])
        self.row = np.repeat(self.order, self.size)  # the row of each clause

    def blocks(self, sizes: np.ndarray) -> list[tuple[int, int, int]]:
        """(first clause, end, length) of the rows of each length."""
        out, at = [], 0
        for t, n in zip(*np.unique(sizes, return_counts=True), strict=True):
            out.append((at, at + n * t, t))
            at += n * t
        return out

    def marginals(self, field: Field) -> list[np.ndarray]:
        """The label marginals of every row."""
        p = np.add.reduceat(field.weights[self.feature], np.cumsum([0, *self.count[:-1]]), axis=0)
        out: list[np.ndarray] = [p] * len(self.order)
        at = 0
        for lo, hi, t in self.blocks(self.size):
            for m in _chains(p[lo:hi].reshape(-1, t, p.shape[1]), field.moves)[0]:
                out[self.order[at]] = m
                at += 1
        return out


def train(rows: Rows, chosen: np.ndarray, labels: list[list[int]], plan: PairPlan, steps: int, start: Field | None = None) -> Field:
    """Fits the field to the ``chosen`` rows by gradients of all of them at once (Adam), from ``start`` on if it is given."""
    k, names = len(LABELS), rows.names
    if not chosen.any():
        return start or Field(names, np.zeros((len(names), k)), np.zeros((k, k)))
    here = chosen[rows.row]
    size = rows.size[chosen[rows.order]]
    label = np.concatenate([labels[i] for i in rows.order if chosen[i]]).astype(np.int64)
    feature, count = rows.feature[np.repeat(here, rows.count)], rows.count[here]
    starts, clause, n = np.cumsum([0, *count[:-1]]), np.repeat(np.arange(len(count)), count), len(count)
    w, m = (start.weights.copy(), start.moves.copy()) if start else (np.zeros((len(names), k)), np.zeros((k, k)))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(m), np.zeros_like(m)]
    target = np.zeros((n, k))
    target[np.arange(n), label] = 1
    by_feature = np.argsort(feature, kind="stable")
    clause_of, present, firsts = clause[by_feature], *np.unique(feature[by_feature], return_index=True)
    for step in range(1, steps + 1):
        p = np.add.reduceat(w[feature], starts, axis=0)
        marginal, gm = np.empty_like(p), np.zeros_like(m)
        for lo, hi, t in rows.blocks(size):
            got, pairs = _chains(p[lo:hi].reshape(-1, t, k), m)
            marginal[lo:hi] = got.reshape(-1, k)
            gm += pairs
            if t > 1:
                ys = label[lo:hi].reshape(-1, t)
                np.subtract.at(gm, (ys[:, :-1].ravel(), ys[:, 1:].ravel()), 1)
        gw = plan.prior * w
        gw[present] += np.add.reduceat((marginal - target)[clause_of], firsts, axis=0)
        for x, g, (i, j) in ((w, gw, (0, 1)), (m, gm, (2, 3))):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[j] = 0.99 * moments[j] + 0.01 * g * g
            x -= 0.15 * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[j] / (1 - 0.99**step)) + 1e-6)
    return Field(names, w, m)


def _chains(p: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_chain`` of many sequences of one length at once; the expected pairs are their sum."""
    n = p.shape[1]
    a, b = np.empty_like(p), np.zeros_like(p)
    a[:, 0] = p[:, 0]
    for i in range(1, n):
        a[:, i] = p[:, i] + _lse(a[:, i - 1, :, None] + moves, 1)
    for i in range(n - 2, -1, -1):
        b[:, i] = _lse(moves + (p[:, i + 1] + b[:, i + 1])[:, None, :], 2)
    z = _lse(a[:, -1], 1)[:, None]
    pairs = np.zeros_like(moves)
    for i in range(1, n):
        pairs += np.exp(a[:, i - 1, :, None] + moves + (p[:, i] + b[:, i])[:, None, :] - z[:, :, None]).sum(0)
    return np.exp(a + b - z[:, :, None]), pairs


# --- labelled rows -----------------------------------------------------------------------------------------------------------


def _english(text: str) -> bool | None:
    ws = norm_words(_plain(text))
    en, other = sum(w in _STOP_EN for w in ws), sum(w in _STOP_OTHER and w not in _STOP_EN for w in ws)
    letters = sum(map(str.isalpha, text))
    if letters and sum(c > "ɏ" and c.isalpha() for c in text) > 0.5 * letters:
        return False
    return True if en >= 3 * max(1, other) and en > 2 else False if other >= 2 * max(1, en) and other > 1 else None


def _sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?…])\s+|\n+", text) if len(s.split()) >= 4]


def refusals(rng: random.Random, topics: list[str], n: int) -> list[str]:
    out = []
    for _ in range(n):
        pick = lambda k: rng.choice(_REFUSE[k])
        s = pick("whole") if rng.random() < 0.3 else pick("open") + pick("deny") + pick("act") + pick("tail")
        out.append((s[0].upper() + s[1:]).replace("{n}", pick("noun")).replace("{x}", rng.choice(topics) if topics else "subject"))
    return out


def examples(pairs: list[tuple[str, str]], plan: PairPlan) -> list[tuple[str, str, str]]:
    """(text, response, label) rows made from a sample of (text, response)."""
    rng = random.Random(plan.seed)
    usable = [(t, r) for t, r in pairs if not is_empty(r) and t and t.strip()]
    topics = [" ".join(r.split()[1:3]).strip(".,;:") for _, r in usable if len(r.split()) > 3 and r.isascii()]
    rows = [(t, r, "answer") for t, r in usable]
    third = max(1, len(usable) // 3)
    for t, r in rng.sample(usable, min(third, len(usable))):
        words = r.split()
        if len(words) < 3:
            continue
        if rng.random() < 0.5:  # within a word
            at = rng.choice([i for i in range(6, len(r) - 1) if r[i].isalpha() and r[i - 1].isalpha()] or [len(r) // 2])
            cut = r[:at]
        else:  # within a phrase, left hanging
            cut = " ".join(words[: rng.randint(2, len(words))]).rstrip(".;,") + rng.choice(_DANGLE)
        rows.append((t, cut, "unfinished"))
    for t, _ in rng.sample(usable, min(third, len(usable))):
        parts = _sentences(t) or [t]
        take = parts[: rng.randint(1, 3)] if rng.random() < 0.5 else [rng.choice(parts)]
        s = " ".join(take)
        kind = rng.random()
        words = s.split()
        if kind < 0.15:
            s = s.upper()
        elif kind < 0.3 and len(words) > 6:
            del words[rng.randrange(1, len(words))]
            s = " ".join(words)
        elif kind < 0.45:
            s = f'"{s}"'
        elif kind < 0.6:
            s = s[: rng.randint(len(s) // 2, len(s))] if len(s) > 120 else s
        if len(norm_words(s)) >= 4:
            rows.append((t, rng.choice(_LEAD) + s, "echo"))
    foreign = [s for t, _ in usable if _english(t) is False for s in _sentences(t)]
    for t, _ in rng.sample(usable, min(third, len(usable))) if foreign else []:
        s = rng.choice(foreign)
        if s in t:
            continue
        s = _plain(s) if rng.random() < 0.4 else s
        s = s.rstrip(".") + "; " + " ".join(rng.choice(foreign).split()[-4:]) if rng.random() < 0.5 else s
        rows.append((t, s, "foreign"))
    for (t, _), s in zip(rng.sample(usable, min(third, len(usable))), refusals(rng, topics, third), strict=False):
        rows.append((t, s, "refusal"))
    return rows


@dataclass
class Judge:
    """What is shared with the workers: the field and the language model; its size is bounded by the sample."""

    field: Field
    languages: Languages

    def defect(self, text: str | None, response: str | None, ending: tuple[float, float, float]) -> str | None:
        """The defect of a pair, or None."""
        if is_empty(response):
            return "empty"
        parts, features = clause_features(response, text or "", ending, self.languages)
        if not parts:
            return "empty"
        p = self.field.marginals(features)
        length = np.array([len(norm_words(x)) for x in parts], dtype=float)
        share = (p * length[:, None]).sum(0) / max(1.0, length.sum())
        refused, echo, foreign, unfinished = p[:, 1].max(), share[2], share[3], p[-1, 4]
        if refused > 0.4 and share[1] > 0.25:
            return "refusal"
        # A copy may break off as well.
        if echo > 0.5 or (len(parts) > 1 and echo > 0.25 and echo + unfinished * length[-1] / max(1.0, length.sum()) > 0.7):
            return "copy"
        if foreign > 0.5:
            return "language"
        return "truncated" if unfinished > 0.3 else None


def ending_of(counts: dict[str, list[int]], longer: dict[str, int], total: int, response: str) -> tuple[float, float, float]:
    ws = norm_words(response)
    n = counts.get(ws[-1], (0, 0)) if ws else (0, 0)
    return usage(n[0], n[1], longer.get(ws[-1], 0) if ws else 0, total)


def fit(pairs: list[tuple[str, str]], plan: PairPlan) -> Judge:
    """Trains on (text, response) pairs of the sample."""
    english = [t for t, _ in pairs if t and _english(t)] + [r for _, r in pairs if r and _english(r)]
    other = [t for t, _ in pairs if t and _english(t) is False]
    languages = Languages(english, other)
    rows = examples(pairs, plan)
    counts: dict[str, list[int]] = {}
    total = sum(label in ("answer", "unfinished") for _, _, label in rows)
    for _, r, label in rows:
        if label in ("answer", "unfinished"):
            ws = norm_words(r)
            for w in ws:
                counts.setdefault(w, [0, 0])[0] += 1
            if ws and not r.rstrip("\"'”").endswith((".", "!", "?", "…")):
                counts[ws[-1]][1] += 1
    longer: dict[str, int] = {}
    for w, (n, _) in counts.items():
        for i in range(1, len(w)):
            longer[w[:i]] = max(longer.get(w[:i], 0), n)

    data = []
    for t, r, label in rows:
        parts, features = clause_features(r, t, ending_of(counts, longer, total, r), languages)
        if not parts:
            continue
        y = LABELS.index(label)
        labels = [0] * (len(parts) - 1) + [y] if label == "unfinished" else [y] * len(parts)
        data.append((features, labels, label, r))
    labels = [y for _, y, _, _ in data]
    given = np.array([label == "answer" for _, _, label, _ in data])
    speaks = np.array([bool(_SPEAKS.search(r)) for *_, r in data])
    if not data:
        return Judge(Field({}, np.zeros((0, len(LABELS))), np.zeros((len(LABELS), len(LABELS)))), languages)
    table = Rows([f for f, *_ in data], [label == "refusal" or (label == "answer" and s) for (_, _, label, _), s in zip(data, speaks, strict=True)])
    # At first, responses that speak of themselves or to the reader are no answers and no refusals. Then each half of the responses
    # as they are is judged by a field that has not seen it.
    chosen, half = ~(given & speaks), np.cumsum(given) % 2
    fields: list[Field | None] = [None, None]
    for turn, most in enumerate((0.5, 0.4, 0.3, 0.15)):
        fields = [train(table, chosen & ~(given & (half != i)), labels, plan, plan.steps if not turn else plan.steps // 3, fields[i]) for i in (0, 1)]
        judged = [table.marginals(f) for f in fields]
        for i in np.flatnonzero(given):
            p = judged[1 - half[i]][i]
            refuses = p[:, 1].min() > 0.3 and p[:, 1].max() > 0.7
            labels[i] = [int(refuses)] * len(p)
            chosen[i] = refuses or _sound(p, most)
    return Judge(train(table, chosen, labels, plan, plan.steps, fields[0]), languages)


_SPEAKS = re.compile(r"\bI(?:['’]|\s|$)|\b(?:me|my|you|your|please)\b(?!-)", re.IGNORECASE)


def _sound(p: np.ndarray, most: float) -> bool:
    return bool(p[:, 1:4].sum(1).max() < most and p[-1, 4] < 0.5)


# --- operator ------------------------------------------------------------------------------------------------------------------


def responses(blocks: DataFrame) -> DataFrame:
    """(block_id, summary_key, value, text) of the model answers; null maps have none, null values are rows."""
    entries = blocks.select("block_id", "text", F.explode(F.map_entries("summaries")).alias("e")).filter(F.col("e.key").startswith("llm:"))
    return entries.select("block_id", F.col("e.key").alias("summary_key"), F.col("e.value").alias("value"), "text")


def word_endings(answers: DataFrame) -> DataFrame:
    """(last, count, final, longer) for every word that ends a response without a full stop, counted over all responses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, final = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(every)
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([every[w] for w in words], pa.int64()), pa.array([final[w] for w in words], pa.int64())], names=["word", "count", "final"])
            every.clear()
            final.clear()
            return out

        for batch in batches:
            for r in batch.column(0).to_pylist():
                ws = norm_words(r)
                every.update(ws)
                if ws and not r.rstrip("\"'”").endswith((".", "!", "?", "…")):
                    final[ws[-1]] += 1
            if len(every) > 300_000:
                yield flush()
        yield flush()

    counted = answers.filter("value is not null").select("value").mapInArrow(run, "word string, count long, final long").groupBy("word").agg(F.sum("count").alias("count"), F.sum("final").alias("final"))
    counted = checkpointed(counted)
    last = counted.filter("final > 0")
    # Prefixes are needed only of the lengths that last words have; these are few.
    lengths = F.array(*[F.lit(r[0]) for r in last.select(F.length("word")).distinct().collect()]).cast("array<int>")
    shorter = F.filter(lengths, lambda i: i < F.length("word"))
    prefixes = counted.select(F.explode(F.transform(shorter, lambda i: F.substring(F.col("word"), F.lit(1), i))).alias("word"), F.col("count").alias("n"))
    longer = prefixes.groupBy("word").agg(F.max("n").alias("longer"))
    return last.join(longer, "word", "left").select(F.col("word").alias("last"), "count", "final", F.coalesce("longer", F.lit(0)).alias("longer"))


def find_defects(blocks: DataFrame, plan: PairPlan | None = None) -> DataFrame:
    """(block_id, summary_key, defect) of the defective model answers among ``blocks`` (block_id, text, summaries).

    Null values are empty answers; null texts cannot be copied; null maps have no answers; repeated rows each give their rows.
    """
    plan = plan or PairPlan()
    answers = responses(blocks)
    total = answers.filter("value is not null").count()
    sample = bounded_sample(answers.filter("value is not null and text is not null").select("block_id", "text", "value"), "block_id", plan.sample_pairs, total, plan.seed)
    shared = blocks.sparkSession.sparkContext.broadcast(fit([(r["text"], r["value"]) for r in sample.collect()], plan))
    endings = checkpointed(word_endings(answers))
    # Frequent last words would be hot keys of a join: they are broadcast, at most ``most_words``.
    few = endings.limit(plan.most_words + 1).count() <= plan.most_words
    frequent = endings if few else checkpointed(endings.orderBy(F.desc("final"), "last").limit(plan.most_words))
    # The last word in the JVM, written as in ``norm_words``.
    token = r"[\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)*|[0-9][0-9.,]*|[%°]"
    tokens = F.regexp_extract(F.lower("value"), rf"(?s)({token})(?:(?!{token}).)*$", 1)
    last = F.when(tokens.rlike("^[0-9]"), F.lit("9")).otherwise(tokens)
    joined = answers.withColumn("last", last).join(F.broadcast(frequent), "last", "left")
    if not few:
        rare = endings.join(frequent.select("last"), "last", "left_anti").select("last", *[F.col(c).alias(f"rare_{c}") for c in ("count", "final", "longer")])
        key = F.when(F.col("count").isNull(), F.col("last"))  # rows of frequent words do not take part
        joined = joined.withColumn("key", key).join(rare.withColumnRenamed("last", "key"), "key", "left").withColumns({c: F.coalesce(c, f"rare_{c}") for c in ("count", "final", "longer")})
    joined = joined.select("block_id", "summary_key", "value", "text", F.coalesce("count", F.lit(0)).alias("n"), F.coalesce("final", F.lit(0)).alias("final"), F.coalesce("longer", F.lit(0)).alias("longer"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            keep, defects = [], []
            for i, (value, text, *n) in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)):
                if defect := judge.defect(text, value, usage(*n, total)):
                    keep.append(i)
                    defects.append(defect)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep, pa.int32())) for c in batch.columns[:2]), pa.array(defects, pa.string())], names=["block_id", "summary_key", "defect"])

    return joined.mapInArrow(run, "block_id long, summary_key string, defect string")
