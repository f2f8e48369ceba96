"""Operators on ordered blocks of a document.

What is carried along a document (sections, pages, junk) is computed in two steps, so that a document with a large share of all
rows is no large group: within pieces of ``PIECE`` positions, and over one summary row for each piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.session import checkpointed

PIECE = 2048


def carry_forward(df: DataFrame, value: Column, out: str, *, key: str, order: list[str]) -> DataFrame:
    """``df`` with ``out``: the last ``value`` that is not null, up to and with the row. ``order[0]`` is an integer position
    from zero, from which the pieces are cut; the other order columns break ties."""
    cut = df.withColumn("__piece", F.floor(F.col(order[0]) / PIECE)).withColumn("__value", value)
    whole = Window.partitionBy(key, "__piece").orderBy(*order)
    inside = cut.withColumn("__inside", F.last("__value", ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    # The last value of each piece, and what the pieces before it hand on: one row for every PIECE rows.
    lasts = cut.groupBy(key, "__piece").agg(F.max(F.when(F.col("__value").isNotNull(), F.struct(*order, F.col("__value").alias("v"))))["v"].alias("__last"))
    handed = lasts.withColumn("__before", F.last("__last", ignorenulls=True).over(Window.partitionBy(key).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1))).drop("__last")
    joined = inside.join(_renamed(handed, key), _same_piece(key), "left")
    return joined.withColumn(out, F.coalesce("__inside", "__before")).drop("__piece", "__value", "__inside", "__before", "__k", "__p")


def _renamed(pieces: DataFrame, key: str) -> DataFrame:
    return pieces.withColumnsRenamed({key: "__k", "__piece": "__p"})


def _same_piece(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("__k")) & F.col("__piece").eqNullSafe(F.col("__p"))


def section_paths(blocks: DataFrame, *, key: str = "paper_id", order: list[str] | None = None) -> DataFrame:
    """``blocks`` with ``path``: an array of the last heading's text, empty before the first."""
    order = order or ["pos", "block_id"]
    filled = carry_forward(blocks, F.when(F.col("type") == "section_header", F.col("text")), "__heading", key=key, order=order)
    return filled.withColumn("path", F.when(F.col("__heading").isNotNull(), F.array("__heading")).otherwise(F.array().cast("array<string>"))).drop("__heading")


def node_numbers(blocks: DataFrame, *, key: str = "paper_id", order: list[str] | None = None) -> DataFrame:
    """``blocks`` with ``node_no`` and ``node``: numbered from 0 within a page."""
    paged = blocks.withColumn("__page", F.struct(key, "page"))
    numbered = number_rows(paged, "__n", key="__page", order=order or ["pos", "block_id"]).withColumn("node_no", (F.col("__n") - 1).cast("int"))
    return numbered.withColumn("node", T.node_id(F.col(key), F.col("page"), F.col("node_no"))).drop("__page", "__n")


def number_rows(df: DataFrame, out: str, *, key: str, order: list[str]) -> DataFrame:
    """``df`` with ``out``: the rank of the row in its document, from 1, by pieces and their sizes."""
    cut = df.withColumn("__piece", F.floor(F.col(order[0]) / PIECE))
    before = cut.groupBy(key, "__piece").agg(F.count("*").alias("__n"))
    before = before.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(key).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = cut.withColumn("__own", F.row_number().over(Window.partitionBy(key, "__piece").orderBy(*order)))
    joined = own.join(_renamed(before, key), _same_piece(key), "left")
    return joined.withColumn(out, F.col("__own") + F.col("__before")).drop("__piece", "__own", "__before", "__k", "__p")


def captions(blocks: DataFrame, *, key: str = "paper_id", order: list[str] | None = None) -> DataFrame:
    """Figures take the text of a caption behind them, which goes.

    In a run of figures whose successors are all captions only every other one is a figure that takes: a block that was taken
    is not asked again. That is the parity of the rank within the run. Neighbours meet by a join on the rank in the document,
    which is spread evenly whatever the size of a document.
    """
    order = order or ["pos", "block_id"]
    numbered = checkpointed(number_rows(blocks, "__n", key=key, order=order))  # read three times below
    behind = numbered.filter(T.is_caption(F.col("text"))).select(F.col(key).alias("__key"), (F.col("__n") - 1).alias("__m"), T.strip(F.col("text")).alias("__caption"))
    asked = numbered.join(behind, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__n") == F.col("__m")), "left").drop("__key", "__m")
    asks = F.coalesce((F.col("type") == "figure") & F.col("__caption").isNotNull(), F.lit(False))
    based = carry_forward(asked.withColumn("__asks", asks), F.when(~F.col("__asks"), F.col("__n")), "__base", key=key, order=order)
    takes = F.col("__asks") & ((F.col("__n") - F.coalesce("__base", F.lit(0))) % 2 == 1)
    # A block is taken if the one before it takes; that one asks, as this one is a caption: the parity tells it here too.
    ranked = checkpointed(based.withColumn("__takes", takes))
    taken = ranked.filter("__takes").select(F.col(key).alias("__key"), (F.col("__n") + 1).alias("__m"))
    left = ranked.join(taken, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__n") == F.col("__m")), "left_anti")
    return left.withColumn("text", F.when(F.col("__takes"), F.col("__caption")).otherwise(F.col("text"))).drop("__n", "__caption", "__asks", "__base", "__takes")


def mark_junk(blocks: DataFrame, *, key: str = "paper_id", order: list[str] | None = None, path: str = "section_path") -> DataFrame:
    """Headings that are journal matter become junk, with what follows under the same section path; texts stay."""
    order = order or ["pos", "block_id"]
    heading = F.col("type") == "section_header"
    state = F.when(heading, F.struct(T.is_junk_heading(F.col("text")).alias("junk"), F.col(path).alias("path")))
    carried = carry_forward(blocks, state, "__state", key=key, order=order)
    junk = F.coalesce(F.col("__state.junk") & (heading | F.col(path).eqNullSafe(F.col("__state.path"))), F.lit(False))
    return carried.withColumn("type", F.when(junk, "junk").otherwise(F.col("type"))).drop("__state")


def assign_pages(chunks: DataFrame, toc: DataFrame, totals: DataFrame, *, key: str = "paper_id", order: list[str] | None = None, most_titles: int = 200) -> DataFrame:
    """``chunks`` with ``page_no``: the page of the last table-of-contents entry whose title (its first forty characters) was
    met, at most the last page; 0 before the first and for documents of one page.

    ``toc`` (key, toc_pos, title, page_id) is a table of contents. One of up to ``most_titles`` titles goes to the chunks of its
    document as an array. A longer one would make as many comparisons as chunks times titles; there the beginnings of the
    titles are an index, in which each place of a chunk is looked up, with the same result. An entry belongs to the first chunk
    that has its title; of several entries the last counts.
    """
    order = order or ["pos", "block_id"]
    title = F.substring(T.strip(F.replace("title", F.lit("\n"), F.lit(" "))), 1, 40)
    # Entries of one title belong to the same chunk, and the last counts: so only distinct titles are looked for.
    entries = toc.select(key, "toc_pos", title.alias("t"), F.coalesce("page_id", F.lit(0)).alias("page_id")).filter("t <> ''").groupBy(key, "t").agg(F.max(F.struct("toc_pos", "page_id")).alias("last"))
    entries = checkpointed(entries.select(key, F.struct(F.col("last.toc_pos").alias("toc_pos"), F.col("t").alias("title"), F.col("last.page_id").alias("page_id")).alias("e")))
    sizes = entries.groupBy(key).agg(F.count("*").alias("n"), F.collect_set(F.least(F.length("e.title"), F.lit(_BEGINNING))).alias("lengths"))
    flat = chunks.select(key, *order, F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")).alias("flat"))

    few = entries.join(sizes.filter(F.col("n") <= most_titles).select(key), key, "left_semi").groupBy(key).agg(F.collect_list("e").alias("__toc"))
    met = flat.join(few, key).select(key, *order, F.explode(F.filter("__toc", lambda t: F.col("flat").contains(t.title))).alias("e"))
    many = checkpointed(sizes.filter(F.col("n") > most_titles).select(key, "lengths"))
    if not many.isEmpty():
        beginning = F.substring("e.title", F.lit(1), F.lit(_BEGINNING)).alias("piece")
        index = entries.join(many.select(key), key, "left_semi").select(key, "e", beginning)
        places = F.transform(F.sequence(F.lit(1), F.length("flat")), lambda i: F.substring("flat", i, F.lit(40)))
        looked = flat.filter("flat <> ''").join(many, key).select(key, *order, F.explode(F.array_distinct(places)).alias("at"), "lengths")
        looked = looked.select(key, *order, "at", F.explode("lengths").alias("n")).select(key, *order, "at", F.substring("at", F.lit(1), F.col("n")).alias("piece"))
        met = met.unionByName(looked.join(index, [key, "piece"]).filter(F.col("at").startswith(F.col("e.title"))).select(key, *order, "e"))
    first = met.groupBy(key, "e").agg(F.min(F.struct(*order)).alias("at"))
    anchors = first.groupBy(key, *[F.col(f"at.{o}").alias(o) for o in order]).agg(F.max_by("e.page_id", "e.toc_pos").alias("__anchor"))
    placed = carry_forward(chunks.join(anchors, [key, *order], "left"), F.col("__anchor"), "__page", key=key, order=order).join(totals.select(key, F.col("total_pages").alias("__total")), key, "left")
    page = F.when(F.coalesce("__total", F.lit(1)) <= 1, 0).otherwise(F.least(F.coalesce("__page", F.lit(0)), F.col("__total") - 1))
    return placed.withColumn("page_no", page.cast("int")).drop("__anchor", "__page", "__total")


#: Characters at the beginning of a title by which it is found.
_BEGINNING = 12


def running_lines(pages: DataFrame, *, share: float = 0.4, edge: int = 3) -> DataFrame:
    """(doc, line) that stand among the first or last lines on at least ``share`` of a document's pages (doc, page, text).

    Documents of fewer than three pages have none; only distinct (document, line, page) are counted, in two partial steps.
    """
    lines = F.split(F.col("text"), "\n")
    n = F.size(lines)
    ends = F.concat(F.slice(lines, 1, edge), F.slice(lines, F.greatest(n - edge + 1, F.lit(1)), edge))
    seen = pages.filter("text is not null").select("doc", "page", F.explode(F.array_distinct(F.transform(ends, T.strip))).alias("line")).filter(F.length("line").between(4, 120)).distinct()
    totals = pages.groupBy("doc").agg(F.count_distinct("page").alias("total")).filter("total >= 3")
    counted = seen.groupBy("doc", "line").agg(F.count("*").alias("n_pages"))
    return counted.join(totals, "doc").filter(F.col("n_pages") >= F.col("total") * share).select("doc", "line", "n_pages", "total")


def strip_running_lines(pages: DataFrame, *, share: float = 0.4) -> DataFrame:
    """``pages`` (doc, page, text) without the running lines of their document; pages left blank go."""
    repeated = running_lines(pages, share=share).groupBy("doc").agg(F.collect_set("line").alias("__lines"))
    joined = pages.join(repeated, "doc", "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.coalesce(F.array_contains("__lines", T.strip(x)), F.lit(False))), "\n")
    text = F.when(F.col("__lines").isNotNull(), T.strip(kept)).otherwise(F.col("text"))
    return joined.withColumn("text", text).filter("text <> ''").drop("__lines")
