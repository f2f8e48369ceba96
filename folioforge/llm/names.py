"""Variant spellings of the names of persons and organisations (problem 3).

Every distinct string is read once into a *form*: a person's surname with a given name that is full, short (a nickname), cut
or an initial, or an organisation's place with the rest of its name. Strings with the same full form are one entity. Then

* typing errors: full forms that agree in one part and are within one edit in the other (``segment_join``) are one entity,
  unless both are well attested, as they are then different names;
* initials, cut and short given names, acronyms and abbreviated words are looked up among the full forms of the same surname
  or place. They are linked if exactly one entity fits; if none fits they form an entity of their own form; if several fit
  they stay unlinked, as nothing in the string tells whom it means.

All of it is grouping and equi-joins on distinct strings; no group is ever expanded but the final pairs of one entity.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.segment_join import similar_pairs, similar_pairs_of_two
from folioforge.session import checkpointed

# Common English short forms of given names and the full names they stand for; others are mined from the corpus.
NICKNAMES: dict[str, tuple[str, ...]] = {
    "alex": ("alexander", "alexandra"), "andy": ("andrew", "andreas"), "becky": ("rebecca",), "ben": ("benjamin",), "bert": ("albert", "robert"),
    "beth": ("elizabeth",), "betty": ("elizabeth",), "bill": ("william",), "bob": ("robert",), "charlie": ("charles",), "chris": ("christopher", "christine"), "chuck": ("charles",),
    "dan": ("daniel",), "dave": ("david",), "debbie": ("deborah",), "deb": ("deborah",), "dick": ("richard",), "ed": ("edward",), "eddie": ("edward",), 
    "frank": ("francis", "franklin"), "fred": ("frederick", "friedrich"), "gabe": ("gabriel",), "greg": ("gregory",), "hans": ("johannes",),
    "harry": ("henry", "harold"), "jack": ("john",), "jim": ("james",), "jimmy": ("james",), "joe": ("joseph",), "johnny": ("john",),
    "kate": ("katherine",), "kathy": ("katherine",), "ken": ("kenneth",), "larry": ("lawrence",),
    "leo": ("leonie", "leonard", "leopold"), "liz": ("elizabeth",), "lizzie": ("elizabeth",), "maggie": ("margaret",), "matt": ("matthew",), "meg": ("margaret",), "mike": ("michael",),
    "mick": ("michael",), "nat": ("nathaniel", "natalie"), "ned": ("edward",), "nick": ("nicholas", "nikolai"),
    "pat": ("patrick", "patricia"), "peggy": ("margaret",), "pete": ("peter",),
    "rick": ("richard",), "rob": ("robert",), "ron": ("ronald",), "sam": ("samuel", "samantha"), "sandy": ("alexander", "sandra"), "sasha": ("alexander", "alexandra"),
    "steve": ("stephen", "steven"), "sue": ("susanna", "susan"), "susie": ("susanna", "susan"), "ted": ("theodore", "edward"), "theo": ("theodore",), "tim": ("timothy",),
    "tom": ("thomas",), "tony": ("anthony", "antonio"), "vicky": ("victoria",), "will": ("william",), 
}
# Words that tell an organisation, with their usual abbreviations; words that belong to no name; strings that name nobody.
BODIES = {"institute": "inst", "laboratory": "lab", "laboratories": "labs", "centre": "ctr", "center": "cent", "observatory": "obs", "department": "dept", "university": "univ", "academy": "acad", "college": "coll", "school": "sch", "faculty": "fac", "society": "soc", "association": "assoc", "agency": "agcy", "foundation": "found", "consortium": "consort", "company": "co", "corporation": "corp", "ministry": "min", "museum": "mus", "hospital": "hosp", "group": "grp", "network": "netw", "survey": "surv"}
FILLERS = {"the", "of", "for", "and", "at", "in", "de", "collaboration", "team"}
TITLES = {"dr", "prof", "professor", "phd", "md", "mr", "mrs", "ms", "sir", "dipl", "ing", "msc", "bsc", "dsc", "jr", "sr", "and"}
NOBODY = {"et al", "anonymous", "anon", "unknown", "unknown author", "none", "null", "nan", "na", "n a", "author", "authors", "various", "various authors", "no author", "tba", "tbd", "editor", "editors"}

_ABBREVIATED = {v: k for k, v in BODIES.items()} | {"centr": "centre", "instit": "institute", "observ": "observatory", "depart": "department"}
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*\.?")
FORM = "kind string, head string, rest string, how string, middle string, turned_head string, turned_rest string, turned_how string"


def fold(s: str) -> str:
    """Lower case without marks; letters that do not decompose keep their usual substitutes."""
    s = unicodedata.normalize("NFKD", s)
    s = "".join(c for c in s if not unicodedata.combining(c))
    return s.casefold().replace("ø", "o").replace("ł", "l").replace("æ", "ae").replace("œ", "oe").replace("đ", "d").replace("’", "").replace("'", "").replace("-", "")


def read_name(name: str | None) -> dict | None:
    """The form of one string, or None for what names nobody.

    Person: head is the surname, rest the given name, ``how`` one of full, nick (rest: the full names it may mean), cut,
    initial; the ``turned`` fields are the other reading where only the corpus can tell which of two words is the surname. Organisation: head is the place, rest the other words
    without fillers, joined; ``how`` is full, cut (abbreviated words) or acronym.
    """
    if name is None:
        return None
    text = unicodedata.normalize("NFKC", name)
    text = re.sub(r"<[^>]*>", " ", text)
    acronym = re.search(r"\(([A-Z]{2,6})\)", text)
    text = re.sub(r"\([^)]*\)", " ", text)
    text = re.sub(r"(?<=[^\W\d_])\d[\d, ]*$|[\d*∗†‡§¶#]+", " ", text)
    plain = " ".join(_WORD.findall(fold(text).replace(".", " ")))
    if not plain or plain in NOBODY:
        return None
    parts = [[w for w in _WORD.findall(p)] for p in text.split(",")]
    # "Doe MD" is a name with initials, not a title: those stand behind a comma or have more words before them.
    joined = len(parts) == 1 and len(parts[0]) == 2 and len(parts[0][1]) <= 3 and parts[0][1].isupper() and parts[0][1].isalpha()
    if not joined:
        parts = [[w for w in p if fold(w).rstrip(".") not in TITLES] for p in parts]
    parts = [p for p in parts if p]
    words = [w for p in parts for w in p]
    if not words:
        return None
    if _is_body(words, bool(acronym)):
        return _read_body(parts)
    return _read_person(parts)


def _is_body(words: list[str], acronym: bool) -> bool:
    low = [fold(w) for w in words]
    if any(w.rstrip(".") in BODIES for w in low) or any(w.rstrip(".") in _ABBREVIATED and w.endswith(".") for w in low):
        return True
    return acronym or (len(low) > 3 and any(w in ("of", "for") for w in low[1:-1]))


def _row(kind: str, head: str, rest: str, how: str, middle: str = "") -> dict:
    return {"kind": kind, "head": head, "rest": rest, "how": how, "middle": middle, "turned_head": "", "turned_rest": "", "turned_how": ""}


def _read_body(parts: list[list[str]]) -> dict:
    # "Kind of Field, Place" has its place last, else it is the first word that is no filler.
    if len(parts) > 1:
        place, rest = parts[-1], [w for p in parts[:-1] for w in p]
    else:
        words = [w for w in parts[0] if fold(w) not in ("the",)]
        place, rest = words[:1], words[1:]
    place_key = "".join(fold(w).rstrip(".") for w in place if fold(w) not in FILLERS)
    kept, short = [], False
    for w in rest:
        f = fold(w)
        if f.rstrip(".") in FILLERS:
            continue
        if f.endswith("."):
            f = f.rstrip(".")
            full = _ABBREVIATED.get(f)
            short |= full is None
            f = full or f + "."
        kept.append("centre" if f == "center" else f)
    # The word for the body comes first, whatever the order in the string ("Field Metrology Institute").
    kept.sort(key=lambda w: w not in BODIES)
    return _row("body", place_key, " ".join(kept), "cut" if short else "full")


def _read_person(parts: list[list[str]]) -> dict:
    def initials(ws: list[str]) -> bool:
        joined = len(ws) == 1 and ws[0].isupper() and len(ws[0]) <= 3 and not ws[0].endswith(".")
        return joined or all(len(w.rstrip(".")) == 1 for w in ws)

    if len(parts) > 1:  # Surname, Given M.
        return _person("".join(fold(w).rstrip(".") for w in parts[0]), parts[1])
    words = parts[0]
    if len(words) == 1:
        glued = re.fullmatch(r"([^\W\d_]*[^\W\d_A-Z])([A-Z][^\W\d_]+)", words[0])
        if not glued:
            return _row("person", fold(words[0]).rstrip("."), "", "none")
        words = [glued[1], glued[2]]
    if len(words[0].rstrip(".")) > 1 and initials(words[1:]) and not all(w.isupper() and len(w) > 3 for w in words):
        tail = "".join(w.rstrip(".") for w in words[1:])
        if len(tail) >= 3 and len(words) == 2:
            return _row("acronym", fold(words[0]), fold(tail), "acronym")
        return _person(fold(words[0]).rstrip("."), list(tail))
    form = _person(fold(words[-1]).rstrip("."), words[:-1])
    if len(words) == 2 and form["how"] in ("full", "nick"):
        other = _person(fold(words[0]).rstrip("."), words[1:])
        form |= {"turned_head": other["head"], "turned_rest": other["rest"], "turned_how": other["how"]}
    return form


def _person(surname: str, given: list[str]) -> dict:
    w = given[0]
    f = fold(w).rstrip(".")
    middle = next((fold(x)[0] for x in given[1:] if len(x.rstrip(".")) == 1), "")
    if len(f) == 1:
        return _row("person", surname, f, "initial", middle)
    if w.endswith("."):
        return _row("person", surname, f, "cut", middle)
    # A short form is written without marks ("Joé" is a mistyped José, no Joe), but for "Léo".
    meant = NICKNAMES.get(f, ()) if f == w.casefold() or f == "leo" else ()
    if len(meant) > 1:
        return _row("person", surname, "|".join(meant), "nick", middle)
    return _row("person", surname, meant[0] if meant else f, "full", middle)


def read_names(names: DataFrame) -> DataFrame:
    """``names`` (name) with the columns of its form; strings that name nobody are dropped."""
    fields = [x.split()[0] for x in FORM.split(", ")]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(n, r) for n in batch.column(0).to_pylist() if (r := read_name(n))]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in got], pa.string()), *(pa.array([r[f] for _, r in got], pa.string()) for f in fields)], names=["name", *fields])

    return names.mapInArrow(run, "name string, " + FORM)


def _turned(forms: DataFrame) -> DataFrame:
    """Two plain words in the order Surname Given are turned round where the corpus knows them so: the roles that words have
    in strings whose order is certain are counted."""
    sure = forms.filter("kind = 'person' and turned_how = '' and how <> 'none'")
    given = sure.filter("how = 'full'").select(F.col("rest").alias("word"), F.lit(1).alias("role"))
    surname = sure.select(F.col("head").alias("word"), F.lit(-1).alias("role"))
    roles = checkpointed(given.unionByName(surname).groupBy("word").agg(F.sum("role").alias("role")))
    # A short form that may mean several names is a given name whatever the corpus says.
    two = forms.filter("turned_how <> ''")
    known = two.join(roles.withColumnsRenamed({"word": "rest", "role": "role_1"}), "rest", "left").join(roles.withColumnsRenamed({"word": "turned_rest", "role": "role_2"}), "turned_rest", "left")
    turn = ((F.coalesce("role_2", F.lit(0)) > 0) | (F.col("turned_how") == "nick")) & (F.coalesce("role_1", F.lit(0)) <= 0) & (F.col("how") != "nick")
    pick = lambda c: F.when(turn, F.col(f"turned_{c}")).otherwise(F.col(c)).alias(c)
    columns = ["name", "kind", "head", "rest", "how", "middle"]
    return forms.filter("turned_how = ''").select(columns).unionByName(known.select("name", "kind", pick("head"), pick("rest"), pick("how"), "middle"))


#: A short form is mined if it stands beside a full name under so many surnames, and under that share of its surnames with
#: two or three given names.
SHORT_SURNAMES, SHORT_SHARE = 2, 0.5


def short_forms(people: DataFrame) -> DataFrame:
    """(rest, meant): given names that are short forms of others, mined from ``people`` (head, rest).

    One person under two given names shows by a surname that hardly anybody else has. Only surnames with two or three given
    names are looked at, so no group is large; a name that stands beside the same other one under several of them, and seldom
    without it, is taken for its short form. The more frequent name is meant, of several the one met most often.
    """
    pairs = people.select("head", "rest").filter("length(rest) > 1").distinct()
    surnames = checkpointed(pairs)
    spread = surnames.groupBy("rest").agg(F.count("*").alias("n"))
    few = surnames.groupBy("head").agg(F.count("*").alias("n")).filter("n between 2 and 3").select("head")
    rare = surnames.join(few, "head", "left_semi")
    beside = rare.join(rare.withColumnRenamed("rest", "meant"), "head").filter("rest <> meant").groupBy("rest", "meant").agg(F.count("*").alias("together"))
    beside = beside.filter(F.col("together") >= SHORT_SURNAMES)
    alone = rare.groupBy("rest").agg(F.count("*").alias("own"))
    judged = beside.join(alone, "rest").join(spread, "rest").join(spread.withColumnsRenamed({"rest": "meant", "n": "n_meant"}), "meant")
    sure = judged.filter((F.col("together") >= SHORT_SHARE * F.col("own")) & (F.struct("n_meant", "meant") > F.struct("n", "rest")))
    return sure.groupBy("rest").agg(F.max_by("meant", F.struct("together", "n_meant", "meant")).alias("meant"))


def _squash(c: str) -> Column:
    return F.replace(F.col(c), F.lit(" "), F.lit(""))


def _merged(keys: DataFrame) -> DataFrame:
    """(kind, head, rest, entity) of the full forms ``keys`` (kind, head, rest, support): those within one typing error share
    an entity, unless both are attested by more than two strings."""
    key = F.concat_ws("|", "kind", "head", "rest")
    by_head = similar_pairs(keys.select(F.concat_ws("|", "kind", "rest").alias("block"), F.col("head").alias("s")).filter("length(s) >= 4"))
    by_rest = similar_pairs(keys.select(F.concat_ws("|", "kind", "head").alias("block"), F.col("rest").alias("s")).filter("length(s) >= 3"))
    kind, other = F.split_part("block", F.lit("|"), F.lit(1)), F.split_part("block", F.lit("|"), F.lit(2))
    pairs = by_head.select(*[F.concat_ws("|", kind, x, other).alias(x) for x in ("a", "b")]).unionByName(by_rest.select(*[F.concat_ws("|", kind, other, x).alias(x) for x in ("a", "b")]))
    # One error in each part: such names are further apart, so one of them must be seen once only and the other often.
    both_parts = similar_pairs_of_two(keys.select(F.col("kind").alias("block"), F.col("head").alias("s_1"), F.col("rest").alias("s_2")))
    twice = both_parts.select(*[F.concat_ws("|", "block", f"{x}_1", f"{x}_2").alias(x) for x in ("a", "b")])
    pairs = checkpointed(pairs.distinct().withColumn("errors", F.lit(1)).unionByName(twice.withColumn("errors", F.lit(2))))
    support = keys.select(key.alias("key"), "support")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "errors"))
    ranked = both.join(support.withColumnsRenamed({"key": "a", "support": "n_a"}), "a").join(support.withColumnsRenamed({"key": "b", "support": "n_b"}), "b")
    rank = lambda n, k: F.struct(-F.col(n), F.col(k))
    attested = F.when(F.col("errors") == 1, F.least("n_a", "n_b") <= 2).otherwise((F.least("n_a", "n_b") == 1) & (F.greatest("n_a", "n_b") >= 4))
    up = ranked.filter(attested & (rank("n_b", "b") < rank("n_a", "a"))).groupBy(F.col("a").alias("key")).agg(F.min(F.struct("errors", (-F.col("n_b")).alias("n"), F.col("b").alias("b")))["b"].alias("up"))
    entity = checkpointed(support.join(up, "key", "left").select("key", F.coalesce("up", "key").alias("entity")))
    while True:  # each key points to a better attested one: follow the pointers, twice as far each time
        step = entity.filter("key <> entity").select(F.col("key").alias("entity"), F.col("entity").alias("next"))
        further = checkpointed(entity.join(step, "entity", "left").select("key", F.coalesce("next", "entity").alias("entity"), F.col("next").isNotNull().alias("moved")))
        entity = further.select("key", "entity")
        if further.filter("moved").isEmpty():
            return keys.join(entity, key == F.col("key")).select("kind", "head", "rest", "entity")


def link_names(names: DataFrame) -> DataFrame:
    """(name, entity) for every distinct string of ``names`` (name) that names somebody.

    Null, blank and nameless strings ("et al.") get no row, repeated strings one; an empty table gives an empty result.
    """
    read = checkpointed(read_names(names.select(F.col("name").cast("string").alias("name")).filter(F.col("name").isNotNull()).distinct()))
    forms = checkpointed(_turned(read))
    person = (F.col("kind") == "person") & (F.col("how") == "full")
    short = short_forms(forms.filter(person)).withColumnRenamed("rest", "__short")
    known_as = F.when(person & (F.length("rest") > 1), F.col("rest")) == F.col("__short")
    forms = checkpointed(forms.join(short, known_as, "left").withColumn("rest", F.coalesce("meant", "rest")).drop("__short", "meant"))

    # Full forms.
    full = forms.filter("how = 'full'").withColumn("words", F.col("rest")).withColumn("rest", _squash("rest"))
    keys = checkpointed(full.groupBy("kind", "head", "rest").agg(F.count("*").alias("support"), F.max("middle").alias("middle"), F.max_by("words", F.struct(F.size(F.split("words", " ")), "words")).alias("words")))
    entity = checkpointed(_merged(keys))
    known = full.join(entity, ["kind", "head", "rest"]).select("name", "entity")
    with_middle = keys.join(entity, ["kind", "head", "rest"])
    middles = with_middle.groupBy("entity").agg(F.max("middle").alias("known_middle"))
    targets = checkpointed(with_middle.select("kind", "head", "rest", "words", "entity").join(middles, "entity"))

    # Given names that are cut, initial or of several meanings are looked up under the surname and the first letter.
    people = targets.filter("kind = 'person'").select("head", F.substring("rest", 1, 1).alias("letter"), F.col("rest").alias("full"), "entity", "known_middle")
    loose = forms.filter("kind = 'person' and how in ('cut', 'initial', 'nick')").select("name", "head", F.posexplode(F.split("rest", r"\|")).alias("rank", "rest"), "how", "middle")
    asked = loose.withColumn("letter", F.substring("rest", 1, 1))
    fits = F.when(F.col("how") == "nick", F.col("full") == F.col("rest")).otherwise(F.col("full").startswith(F.col("rest")))
    same_middle = (F.col("middle") == "") | (F.col("known_middle") == "") | (F.col("middle") == F.col("known_middle"))
    # Of several that fit, one with the same middle initial is meant, and of the meanings of a short name the usual one.
    exact = ((F.col("middle") != "") & (F.col("middle") == F.col("known_middle"))) | ((F.col("how") == "nick") & (F.col("rank") == 0))
    hits = checkpointed(asked.join(people, ["head", "letter"]).filter(fits & same_middle).select("name", "entity", exact.alias("exact")))
    found = _only_one(hits)

    # Where none fits: the same through surnames within one typing error, else an entity of the form itself.
    lost = checkpointed(asked.join(hits.select("name").distinct(), "name", "left_anti"))
    heads = lost.select("letter", "head").unionByName(people.select("letter", "head"))
    near = similar_pairs(heads.select(F.col("letter").alias("block"), F.col("head").alias("s")).filter("length(s) >= 5"))
    near = near.unionByName(near.select("block", F.col("b").alias("a"), F.col("a").alias("b"))).withColumnsRenamed({"block": "letter", "a": "head", "b": "other"})
    by_near = lost.join(near, ["head", "letter"]).drop("head").withColumnRenamed("other", "head").join(people, ["head", "letter"])
    found_near = checkpointed(_only_one(by_near.filter(fits & same_middle).select("name", "entity", F.lit(False).alias("exact"))))
    own_form = lost.join(found_near.select("name"), "name", "left_anti").groupBy("name").agg(F.concat_ws("|", F.lit("initial"), F.min("head"), F.min("letter")).alias("entity"))

    # Organisations: acronyms and abbreviated words are looked up under the place.
    bodies = targets.filter("kind = 'body'").select("head", "words", "entity")
    letters = F.array_join(F.transform(F.split("words", " "), lambda w: F.substring(w, 1, 1)), "")
    acronyms = forms.filter("kind = 'acronym'").select("name", "head", F.col("rest").alias("letters"))
    cut = forms.filter("kind = 'body' and how = 'cut'").select("name", "head", F.col("rest").alias("short"))
    by_acronym = acronyms.join(bodies.withColumn("letters", letters), ["head", "letters"]).select("name", "entity")
    short_words, full_words = F.split("short", " "), F.split("words", " ")
    each = F.zip_with(short_words, full_words, lambda s, w: F.coalesce(F.when(s.endswith("."), w.startswith(F.rtrim(s, F.lit(".")))).otherwise(s == w), F.lit(False)))
    by_words = cut.join(bodies, "head").filter((F.size(short_words) == F.size(full_words)) & F.forall(each, lambda x: x)).select("name", "entity")
    found_body = checkpointed(_only_one(by_acronym.unionByName(by_words).withColumn("exact", F.lit(False))))
    unknown = cut.select("name", F.concat_ws("|", F.lit("body"), "head", "short").alias("entity")).unionByName(acronyms.select("name", F.concat_ws("|", F.lit("acronym"), "head", "letters").alias("entity")))
    unknown = unknown.join(found_body.select("name"), "name", "left_anti")

    parts = [known, found, found_near, own_form, found_body, unknown]
    return reduce(DataFrame.unionByName, parts)


def _only_one(hits: DataFrame) -> DataFrame:
    """(name, entity) of the names in ``hits`` (name, entity, exact) that fit one entity only, or only one exactly."""
    each = hits.groupBy("name", "entity").agg(F.max("exact").alias("exact"))
    one = each.groupBy("name").agg(F.count("*").alias("n"), F.count_if("exact").alias("n_exact"), F.min("entity").alias("any"), F.min(F.when(F.col("exact"), F.col("entity"))).alias("best"))
    return one.filter("n = 1 or n_exact = 1").select("name", F.when(F.col("n_exact") == 1, F.col("best")).otherwise(F.col("any")).alias("entity"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """Distinct (name_a, name_b), name_a < name_b by code point, of one entity."""
    linked = checkpointed(linked)
    other = linked.select("entity", F.col("name").alias("name_b"))
    # Spark compares strings by their UTF-8 bytes, which is the order of code points.
    return linked.select("entity", F.col("name").alias("name_a")).join(other, "entity").filter("name_a < name_b").select("name_a", "name_b").distinct()
