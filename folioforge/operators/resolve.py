"""Metadata from several sources: overrides, ranked candidates, rescue from texts, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.session import checkpointed

# Fields that a sidecar may override, and the order of the sources of a DOI, best first.
OVERRIDES = ("title", "year", "doi", "abstract", "journal", "s2_id", "arxiv_id")
PROVENANCE = ("bundle", "sidecar", "secondary_validator", "internal", "existing_tags", "filename")


def ranked(column: Column, values: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*map(F.lit, values)), column)


def override(headers: DataFrame, sidecars: DataFrame, on: str) -> DataFrame:
    """``headers`` with the fields that their sidecar (``on``, body) sets: an absent or empty one keeps, null clears, any other
    overrides. Bodies that are no JSON objects count as empty. ``authors`` become the names of a string or a list.

    The three states of a field are told apart by the keys of the object and by its value.
    """
    body = F.when(F.get_json_object("body", "$").startswith("{") & F.try_parse_json("body").isNotNull(), F.col("body"))
    side = sidecars.select(on, body.alias("__body"))
    joined = headers.join(side, on, "left").withColumn("__keys", F.coalesce(F.json_object_keys("__body"), F.array().cast("array<string>")))
    out = {}
    for name in OVERRIDES:
        present, value = F.array_contains("__keys", name), F.get_json_object("__body", f"$.{name}")
        kind = headers.schema[name].dataType.simpleString()
        out[name] = F.when(~present, F.col(name)).when(value.isNull(), F.lit(None).cast(kind)).when(value == "", F.col(name)).otherwise(value.try_cast(kind))
    raw = F.get_json_object("__body", "$.author")
    listed = F.from_json(raw, "array<string>")
    author = F.when(~F.array_contains("__keys", "author"), F.col("authors.name")).when(raw.isNull(), F.array().cast("array<string>")).when(raw == "", F.col("authors.name"))
    out["author_names"] = author.when(raw.startswith("["), F.filter(listed, lambda x: x.isNotNull() & (x != ""))).otherwise(F.array(raw))
    return joined.withColumns(out).drop("__body", "__keys")


def document_type(sidecar_type: Column, given: Column) -> Column:
    return F.coalesce(T.blank_to_null(sidecar_type), given)


def best_doi(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """(id, doi, provenance, validated) of the best of ``candidates`` (id, pos, doi, provenance) for each id.

    DOIs found in the catalogue ``known`` (doi) come first; then the order of the sources, then the position. It is a minimum
    by a struct, which is computed partially before the shuffle, so an id with any number of candidates is no large group.
    """
    normal = candidates.withColumn("doi", T.normal_doi(F.col("doi"))).filter(T.valid_doi(F.col("doi")))
    checked = normal.join(known.select(T.normal_doi(F.col("doi")).alias("doi")).distinct().withColumn("__known", F.lit(True)), "doi", "left")
    valid = F.coalesce("__known", F.lit(False))
    rank = F.struct(F.when(valid, 0).otherwise(1).alias("r"), ranked(F.col("provenance"), PROVENANCE).alias("p"), F.col("pos"), F.col("doi"))
    best = checked.groupBy("id").agg(F.min_by(F.struct("doi", "provenance", valid.alias("validated")), rank).alias("b"))
    return best.select("id", "b.doi", "b.provenance", "b.validated")


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[T.blank_to_null(c) for c in columns])


def merge_sources(bundle: DataFrame, sidecar: DataFrame, catalog: DataFrame, embedded: DataFrame) -> DataFrame:
    """One record for each id: the bundle's fields, title and authors by the sidecar, gaps by the catalogue and then by what is
    embedded in the file. All tables have (id, title, authors, year, journal, doi), the right ones one row for each id."""
    names = ("title", "authors", "year", "journal", "doi")
    joined = bundle.select("id", *names)
    for prefix, side in (("s", sidecar), ("c", catalog), ("e", embedded)):
        joined = joined.join(side.select("id", *[F.col(n).alias(f"{prefix}_{n}") for n in names]), "id", "left")
    filled = lambda c: F.when(F.size(c) > 0, F.col(c))
    return joined.select(
        "id",
        first_filled(F.col("s_title"), F.col("title"), F.col("c_title"), F.col("e_title")).alias("title"),
        F.coalesce(filled("s_authors"), filled("authors"), filled("c_authors"), filled("e_authors")).alias("authors"),
        F.coalesce("year", "c_year").alias("year"),
        first_filled(F.col("journal"), F.col("c_journal")).alias("journal"),
        first_filled(F.col("doi"), F.col("c_doi")).alias("doi"),
    )


def local_header(title: Column, author: Column, created: Column, doi: Column, stem: Column) -> Column:
    """Struct (title, authors, year, doi, source) from what a file says about itself."""
    digits = F.substring(F.regexp_replace(created, "^D:", ""), 1, 4)
    year = F.when(digits.rlike("^[0-9]{4}$"), digits.try_cast("int"))
    return F.struct(
        F.coalesce(T.blank_to_null(title), F.translate(stem, "_-", "  ")).alias("title"),
        F.when(T.blank_to_null(author).isNotNull(), F.array(author)).otherwise(F.array().cast("array<string>")).alias("authors"),
        F.when(year.between(1900, 2100), year).alias("year"),
        T.blank_to_null(doi).alias("doi"),
        F.lit("local").alias("source"),
    )


def rejection(verified: Column, warnings: Column, doi: Column, arxiv: Column, s2: Column, title: Column, slug: Column) -> Column:
    """Why a paper is not taken, or null."""
    unknown = T.blank_to_null(doi).isNull() & T.blank_to_null(arxiv).isNull() & T.blank_to_null(s2).isNull()
    t = F.lower(T.strip(F.coalesce(title, F.lit(""))))
    poor = (t == "") | (t == "untitled") | t.startswith("pii:") | t.startswith("pii ") | (F.length(t) < 5)
    why = F.concat(F.lit("unverified"), F.when(F.size(warnings) > 0, F.concat(F.lit(": "), F.array_join(warnings, "; "))).otherwise(""))
    return F.when(~F.coalesce(verified, F.lit(False)), why).when(unknown & poor, "garbage title").when(unknown & F.coalesce(slug, F.lit("")).startswith("anon"), "anonymous")


def update_decision(force: Column, doi: Column, title: Column, author: Column, old_identifier: Column, old_keywords: Column, old_title: Column, old_author: Column) -> Column:
    """Struct (update, reason): whether tags of a file are to be written; the first reason holds."""
    none = F.lit("")
    o = {k: F.coalesce(v, none) for k, v in {"i": old_identifier, "k": old_keywords, "t": old_title, "a": old_author}.items()}
    lacks_doi = (F.coalesce(doi, none) != "") & ~F.lower(o["i"]).contains(F.concat(F.lit("doi:"), F.lower(doi))) & ~F.lower(o["k"]).contains(F.lower(doi))
    reason = (
        F.when(F.coalesce(force, F.lit(False)), "forced")
        .when(F.coalesce(lacks_doi, F.lit(False)), "doi missing")
        .when((F.coalesce(title, none) != "") & (F.length(o["t"]) < 10), "title missing")
        .when((F.coalesce(author, none) != "") & (o["a"] == ""), "author missing")
        .otherwise("up to date")
    )
    return F.struct((reason != "up to date").alias("update"), reason.alias("reason"))


def similarity(a: Column, b: Column) -> Column:
    """1 minus the edit distance as a share of the longer text; texts are compared in lower case without white space."""
    x, y = (F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+", "") for c in (a, b))
    return 1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))


def verification(verify: Column, kind: Column, sidecar_verified: Column, title: Column, first_page: Column, least: float = 0.8) -> Column:
    """Struct (verified, warning): local kinds and what need not be verified are; then the sidecar's word; then the likeness of
    the title and the beginning of the first page; else not."""
    head = F.substring(F.regexp_replace(F.coalesce(first_page, F.lit("")), r"(?U)\s+", ""), F.lit(1), F.length(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)\s+", "")))
    likely = similarity(title, head) >= least
    verified = F.when(~verify | kind.isin(*T.LOCAL_TYPES), True).when(sidecar_verified.isNotNull(), sidecar_verified).when(T.blank_to_null(first_page).isNotNull(), likely).otherwise(False)
    warning = F.when(~verified & sidecar_verified.isNotNull(), "sidecar says unverified").when(~verified & T.blank_to_null(first_page).isNotNull(), "title not on first page").when(~verified, "nothing to verify with")
    return F.struct(verified.alias("verified"), warning.alias("warning"))


# Fields that a catalogue hit brings along.
CATALOG_FIELDS = ("title", "authors", "year", "doi", "arxiv_id", "journal", "abstract", "s2_id")


def rescue(blocks: DataFrame, headers: DataFrame, catalog: DataFrame | None = None, *, key: str = "paper_id") -> DataFrame:
    """(key, title, authors, year, doi, arxiv_id, journal, abstract, s2_id, source) of the documents whose ``headers`` lack a
    title or authors and whose first blocks have them; what was not found is null.

    Of the first 15 blocks the first five of text are looked at. The title is the first that is no numbered or usual heading:
    whole up to 300 characters, of a longer one what ``split_title`` reads. The authors come with such a title or from a block that
    reads like a list of names. If a title was found and there is no DOI, the ``catalog`` (title, and any of
    authors as strings, year, ...) is asked: of its rows with that title those within two years of the header's year count (a missing year fits), and the
    nearest, then the smallest DOI, replaces what it has. The blocks are limited by rank before anything is grouped.
    """
    w = Window.partitionBy(key).orderBy("pos", "block_id")
    text = T.strip(F.coalesce("text", F.lit("")))
    early = blocks.select(key, "pos", "block_id", "type", text.alias("t")).withColumn("__n", F.row_number().over(w)).filter("__n <= 15")
    some = early.filter(~F.coalesce("type", F.lit("")).isin("junk", "equation", "figure", "table") & (F.length("t") >= 5)).withColumn("__n", F.row_number().over(w)).filter("__n <= 5")
    lists = some.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "t"))), lambda x: x.t).alias("__texts"))
    need = headers.select(key, "title", "authors", "doi", "year").join(lists, key)
    lacks_title, lacks_authors = T.blank_to_null(F.col("title")).isNull(), F.coalesce(F.size("authors"), F.lit(0)) <= 0
    usable = F.filter("__texts", lambda t: ~t.rlike(r"(?U)^\d+[.\s]") & ~F.lower(t).isin("abstract", "contents", "references"))
    none = F.lit(None).cast("array<string>")
    read = F.transform(usable, lambda t: F.when(F.length(t) <= 300, F.struct(t.alias("title"), none.alias("authors"))).otherwise(T.split_title(t)))
    need = need.withColumn("__read", F.when(lacks_title, F.get(F.filter(read, lambda x: x["title"].isNotNull()), F.lit(0))))
    own_title = F.coalesce(F.col("__read.title"), T.blank_to_null(F.col("title")), F.lit(""))

    def names(t: Column) -> Column:
        plain = (t != own_title) & (F.length(t) <= 500) & (F.regexp_count(t, F.lit(r"\. ")) <= 3) & ~F.lower(t).rlike("^(abstract|keyword)")
        return F.when(plain, T.parse_authors(t))

    listed = F.get(F.filter(F.transform("__texts", names), lambda x: x.isNotNull()), F.lit(0))
    found = need.withColumn("__authors", F.when(lacks_authors, F.coalesce("__read.authors", listed)))
    found = found.select(key, F.col("__read.title").alias("title"), F.col("__authors").alias("authors"), F.col("year").alias("__year"), T.blank_to_null(F.col("doi")).alias("__doi")).filter("title is not null or authors is not null")
    found = checkpointed(found)  # what follows would plan the long expressions above again and again
    strings = [f for f in CATALOG_FIELDS if f not in ("title", "authors", "year")]
    if catalog is None:
        empty = [F.lit(None).cast("int").alias("year"), *[F.lit(None).cast("string").alias(f) for f in strings]]
        return found.select(key, "title", "authors", *empty, F.lit("text_rescue").alias("source"))
    kinds = {"year": "int", "authors": "array<string>"}
    fields = [F.col(f).cast(kinds.get(f, "string")).alias(f) if f in catalog.columns else F.lit(None).cast(kinds.get(f, "string")).alias(f) for f in CATALOG_FIELDS]
    known = catalog.filter("title is not null and title <> ''").select(F.lower("title").alias("__t"), F.struct(*fields).alias("__hit"))
    asked = found.select(key, F.lower("title").alias("__t"), "__year").filter(F.col("title").isNotNull() & F.col("__doi").isNull())
    apart = F.abs(F.coalesce(F.col("__hit.year") - F.col("__year"), F.lit(0)))
    best = asked.join(known, "__t").filter(apart <= 2).groupBy(key).agg(F.min_by("__hit", F.struct(apart, F.col("__hit.doi"), F.to_json("__hit"))).alias("__hit"))
    joined = found.join(best, key, "left")
    hit = lambda f: F.col(f"__hit.{f}")
    authors = F.coalesce(F.when(F.size(hit("authors")) > 0, hit("authors")), F.col("authors"))
    source = F.when(F.col("__hit").isNotNull(), "catalog_rescue").otherwise("text_rescue")
    return joined.select(key, first_filled(hit("title"), F.col("title")).alias("title"), authors.alias("authors"), hit("year").alias("year"), *[T.blank_to_null(hit(f)).alias(f) for f in strings], source.alias("source"))


def fix_up(headers: DataFrame, blocks: DataFrame, catalog: DataFrame | None = None, *, key: str = "paper_id") -> DataFrame:
    """``headers`` after a rescue: titles that are none are cleared, what was rescued replaces what it has, and rescued papers get
    a new slug and are verified anew against ``first_page``, unless they are local or the sidecar said so (``sidecar_verified``).

    Returns (key, title, authors, year, doi, slug, verified, source, rescued); ``headers`` has (key, title, authors as structs,
    year, doi, slug, verified, entry_type, sidecar_verified, first_page).
    """
    cleared = headers.withColumn("title", F.when(~T.is_garbage_title(F.col("title")), F.col("title")))
    found = rescue(blocks, cleared, catalog, key=key)
    side = found.select(key, *[F.col(c).alias(f"__{c}") for c in ("title", "authors", "year", "doi", "source")])
    joined = cleared.join(side, key, "left").withColumn("rescued", F.col("__source").isNotNull())
    names = F.coalesce("__authors", F.col("authors.name"))
    merged = joined.withColumns({"title": first_filled(F.col("__title"), F.col("title")), "__names": names, "year": F.coalesce("__year", "year"), "doi": first_filled(F.col("__doi"), F.col("doi"))})
    again = F.col("rescued") & ~F.coalesce(F.col("entry_type").isin(*T.LOCAL_TYPES), F.lit(False)) & F.col("sidecar_verified").isNull() & T.blank_to_null(F.col("first_page")).isNotNull()
    anew = verification(F.lit(True), F.col("entry_type"), F.col("sidecar_verified"), F.col("title"), F.col("first_page"))["verified"]
    return merged.select(
        key, "title", F.col("__names").alias("authors"), "year", "doi", F.when(F.col("rescued"), T.slug("__names", "year", "title")).otherwise(F.col("slug")).alias("slug"),
        F.when(again, anew).otherwise(F.col("verified")).alias("verified"), F.col("__source").alias("source"), "rescued",
    )


# File names that tell a DOI, as (pattern, DOI).
FILE_NAME_DOIS = ((r"^(s\d{5}-\d{3}-\d{4,5}-[0-9a-z]{1,2})(?:_.*)?$", "10.1038/$1"), (r"^((?:PhysRev|RevModPhys)[A-Za-z]*\.\d+\.\d+)(?:_.*)?$", "10.1103/$1"), (r"^(10\.\d{4,})[_-](\S+)$", "$1/$2"), (r"^(journal\.[a-z]{4}\.\d{7})(?:_.*)?$", "10.1371/$1"))


def doi_of_file_name(stem: Column) -> Column:
    """The DOI that a file name tells by the habits of some publishers, or null."""
    return F.coalesce(*[F.when(stem.rlike(pattern), F.regexp_replace(stem, pattern, by)) for pattern, by in FILE_NAME_DOIS])


def doi_candidates(files: DataFrame) -> DataFrame:
    """(id, pos, doi, provenance) of every DOI that ``files`` (id, stem, identifier, keywords, subject, internal) name: in the
    tags of the file, in what was read from it, and in its name, in this order; for ``best_doi``."""
    tags = [F.struct(F.lit(i).alias("pos"), T.doi_in(F.col(c)).alias("doi"), F.lit("existing_tags").alias("provenance")) for i, c in enumerate(("identifier", "keywords", "subject"))]
    others = [F.struct(F.lit(3).alias("pos"), F.col("internal").alias("doi"), F.lit("internal").alias("provenance")), F.struct(F.lit(4).alias("pos"), doi_of_file_name(F.col("stem")).alias("doi"), F.lit("filename").alias("provenance"))]
    every = files.select("id", F.explode(F.array(*tags, *others)).alias("c")).select("id", "c.pos", T.normal_doi(F.col("c.doi")).alias("doi"), "c.provenance")
    return every.filter(T.valid_doi(F.col("doi")))


# Lengths of the beginnings by which stems are sorted into classes. Names of files have at most 255 characters;
# what is longer belongs to the last class.
STEM_CLASSES = (1, 2, 4, 8, 16, 32, 64, 128)


def contained(longs: DataFrame, shorts: DataFrame) -> DataFrame:
    """(stem, piece), distinct: every piece of the ``longs`` (stem) that may be one of the ``shorts`` (stem); it contains all
    that are, and few others. The caller compares pieces and stems.

    The class of a short stem is the longest beginning of a fixed length that fits in it. Of the grams of this beginning the one
    with the smallest hash, the first of equals, is its key; a stem that contains it has the same gram as smallest of the window
    at that place, so it is looked up by the smallest gram of each of its windows, which neighbouring windows share from class 8
    on. A key has the offsets and lengths of its stems, not the stems: a key that many stems share has one row.
    """

    def smallest(stem: Column, windows: Column, n: Column) -> Column:
        """The distinct (gram's hash, place) of the first ``windows`` windows of ``n`` characters."""
        gram = F.greatest(F.least(n, F.lit(4)), F.floor(n / 2).cast("int"))
        grams = F.transform(F.sequence(F.lit(1), windows + n - gram), lambda i: F.struct(F.xxhash64(F.substring(stem, i, gram)).alias("gram"), i.alias("at")))
        # Bound by an array of one, so that the grams are made once for a stem, not once for a window.
        each = F.transform(F.array(grams), lambda g: F.transform(F.sequence(F.lit(1), windows), lambda i: F.array_min(F.slice(g, i, n - gram + 1))))
        return F.array_distinct(F.flatten(each))

    n = F.lit(None).cast("int")
    for size in STEM_CLASSES:
        n = F.when(F.length("stem") >= size, size).otherwise(n)
    # By explode, though it is one: the filter for nulls that Spark adds would else compute it for every row before the distinct.
    entries = shorts.select("stem", n.alias("n")).select("n", F.length("stem").alias("length"), F.explode(smallest(F.col("stem"), F.lit(1), F.col("n"))).alias("g"))
    used = shorts.agg(F.array_sort(F.collect_set(n)).alias("classes"))  # one row of at most as many numbers as there are classes
    keys = entries.groupBy("n", "g.gram").agg(F.collect_set(F.struct(F.col("g.at").alias("offset"), "length")).alias("forms"))
    tasks = int(longs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes become many rows
    classed = longs.repartition(tasks).join(F.broadcast(used)).select("stem", F.explode("classes").alias("n")).filter(F.length("stem") >= F.col("n"))
    lookups = classed.select("stem", "n", F.explode(smallest(F.col("stem"), F.length("stem") - F.col("n") + 1, F.col("n"))).alias("g")).select("stem", "n", "g.gram", "g.at")
    # Spark takes the size of lookups for that of the stems: without the hint it may send them all to the driver and broadcast them.
    met = lookups.hint("merge").join(keys, ["n", "gram"]).select("stem", "at", F.explode("forms").alias("form"))
    first, length = F.col("at") - F.col("form.offset") + 1, F.col("form.length")
    return met.filter((first >= 1) & (first + length - 1 <= F.length("stem"))).select("stem", F.substring("stem", first, length).alias("piece")).distinct()


def find_bundles(files: DataFrame, bundles: DataFrame) -> DataFrame:
    """(path, bundle) for each file: the bundle of the same stem beside it, else one in its or the parent directory whose stem
    contains the file's or is contained in it; ties go to the nearer directory, then to the smaller path.

    Stems that may be contained in others come from ``contained``; then directory and stem are compared as a whole, with one
    bundle, the smallest, for each. So a directory with any number of files, and a name part that all of them share, forms no
    pairs: the rows grow with the number of names. All joins of tables are by sort and merge: no side is broadcast.
    """

    def parts(df: DataFrame) -> DataFrame:
        p = F.col("path")
        return df.select(p, F.regexp_replace(p, "/[^/]*$", "").alias("dir"), F.regexp_replace(F.substring_index(p, "/", -1), r"\.[^.]*$", "").alias("stem"))

    above = F.regexp_replace("dir", "/[^/]*$", "")
    f = parts(files)
    b = parts(bundles).filter("stem <> ''").groupBy("dir", "stem").agg(F.min("path").alias("bundle"))
    alone = f.filter("stem <> ''").select("dir", "stem").distinct().hint("merge").join(b, ["dir", "stem"], "left_anti")
    asked = checkpointed(alone.select(F.explode(F.array("dir", above)).alias("dir"), "stem").distinct())
    there = checkpointed(b.hint("merge").join(asked.select("dir").distinct(), "dir", "left_semi"))
    file_stems, bundle_stems = asked.select("stem").distinct(), there.select("stem").distinct()
    within = contained(file_stems, bundle_stems).hint("merge").join(asked, "stem").hint("merge").join(there.withColumnRenamed("stem", "piece"), ["dir", "piece"])
    around = contained(bundle_stems, file_stems).hint("merge").join(there, "stem").select("dir", F.col("piece").alias("stem"), "bundle")
    near = within.select("dir", "stem", "bundle").unionByName(around).groupBy("dir", "stem").agg(F.min("bundle").alias("bundle"))
    own, beside, over = (x.withColumnRenamed("bundle", name) for x, name in ((b, "__own"), (near, "__beside"), (near.withColumnRenamed("dir", "__above"), "__over")))
    every = f.withColumn("__above", above).hint("merge").join(own, ["dir", "stem"], "left").hint("merge").join(beside, ["dir", "stem"], "left").hint("merge").join(over, ["__above", "stem"], "left")
    return every.select("path", F.coalesce("__own", "__beside", "__over").alias("bundle"))


def find_parents(supplements: DataFrame, papers: DataFrame) -> DataFrame:
    """(name, parent): the paper whose slug, DOI or id the supplement names, in this order; a union of three equi-joins."""
    hits = None
    for rank, column in enumerate(("slug", "doi", "ref_id")):
        one = supplements.join(papers.select(F.col(column).cast("string").alias("key"), F.col("ref_id").alias("parent")), supplements["parent_key"] == F.col("key")).select("name", F.struct(F.lit(rank).alias("r"), "parent").alias("h"))
        hits = one if hits is None else hits.unionByName(one)
    return supplements.select("name").join(hits.groupBy("name").agg(F.min("h")["parent"].alias("parent")), "name", "left")
