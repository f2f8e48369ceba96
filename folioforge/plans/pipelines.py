"""Whole pipelines: documents to blocks, blocks to bundles, metadata to tag updates, files to outcomes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import documents as D
from folioforge.operators import enrich as E
from folioforge.operators import maintain as M
from folioforge.operators import resolve as R
from folioforge.operators import sequence as S
from folioforge.session import checkpointed
from folioforge.sources import bundles as B

BLOCK_COLUMNS = ("paper_id", "pos", "block_id", "node_id", "page", "type", "text", "section_path")


def extract_blocks(documents: DataFrame, toc: DataFrame | None = None, totals: DataFrame | None = None, images: DataFrame | None = None) -> DataFrame:
    """Blocks of ``documents`` (paper_id, markdown), of a converter of any kind.

    Clean, cut into paragraphs, assign pages by the table of contents (paper_id, toc_pos, title, page_id) and the numbers of
    pages (paper_id, total_pages), classify, carry sections, split what is long, number, attach images (doc_id, image_pos,
    name), merge captions, mark junk. Formulas too short to keep and figures without text give no block.
    """
    parts = D.paragraphs(D.clean(documents.select("paper_id", F.col("markdown").alias("text"))))
    raw = parts.select("paper_id", F.col("chunk_no").alias("pos"), F.lit(0).cast("long").alias("block_id"), F.col("chunk").alias("text"))
    if toc is not None and totals is not None:
        placed = S.assign_pages(raw, toc, totals).withColumnRenamed("page_no", "page")
    else:
        placed = raw.withColumn("page", F.lit(0))
    typed = placed.withColumn("raw", F.col("text")).withColumn("c", T.classify(F.col("text"))).withColumn("type", F.col("c.type"))
    title = F.when(F.col("type") == "section_header", T.strip_links(F.col("c.text"))).otherwise(F.col("c.text"))
    # What carries values along a document reads its input twice: the lineage is cut where such steps follow each other.
    kept = checkpointed(typed.withColumn("text", title).drop("c").filter("type <> 'skip'"))
    sections = S.section_paths(kept).withColumnRenamed("path", "section_path")
    if images is not None:
        refs = sections.filter(F.size(T.image_refs(F.col("raw"))) > 0).select(F.col("paper_id").alias("doc_id"), F.col("pos").alias("block_pos"), F.posexplode(T.image_refs(F.col("raw"))).alias("ref_no", "ref"))
        found = B.join_images(refs.select("doc_id", F.struct("block_pos", "ref_no").alias("pos"), "ref"), images).filter("image is not null")
        first = found.groupBy("doc_id", F.col("pos.block_pos").alias("block_pos")).agg(F.min_by("image", F.col("pos.ref_no")).alias("image"))
        sections = sections.join(first, (F.col("paper_id") == F.col("doc_id")) & (F.col("pos") == F.col("block_pos")), "left").drop("doc_id", "block_pos")
        sections = sections.withColumn("type", F.when(F.col("image").isNotNull(), "figure").otherwise(F.col("type")))
    split = D.chunks(checkpointed(sections.drop("raw"))).withColumnsRenamed({"chunk": "text", "chunk_no": "block_no"})
    ordered = split.withColumn("block_id", F.col("block_no").cast("long")).drop("block_no")
    numbered = checkpointed(S.node_numbers(ordered).withColumnRenamed("node", "node_id").drop("node_no"))
    extra = ["image"] if images is not None else []
    return S.mark_junk(S.captions(numbered)).select(*BLOCK_COLUMNS, *extra)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Blocks of ``pages`` (paper_id, page, text): the fallback where there is no structure.

    Clean, strip running lines, split each page, take short lines that look so for headings, carry sections; numbers begin
    anew on each page.
    """
    clean = D.clean(pages.select(F.col("paper_id").alias("doc"), "page", "text")).filter("text <> ''")
    stripped = S.strip_running_lines(checkpointed(clean)).select(F.col("doc").alias("paper_id"), "page", "text")
    parts = D.chunks(stripped.withColumn("type", F.lit("text"))).withColumnRenamed("chunk", "text")
    typed = parts.withColumn("type", F.when(T.is_heading(F.col("text")), "section_header").otherwise("text")).withColumn("pos", F.col("page")).withColumn("block_id", F.col("chunk_no").cast("long"))
    sections = S.section_paths(checkpointed(typed)).withColumnRenamed("path", "section_path")
    return S.node_numbers(sections).withColumnRenamed("node", "node_id").select(*BLOCK_COLUMNS)


def extract_or_fall_back(structured: DataFrame, pages: DataFrame) -> DataFrame:
    """Blocks of ``structured`` (paper_id, markdown, error); for papers that are missing or broken there, of their pages."""
    good = structured.filter("error is null and markdown is not null")
    rest = pages.join(good.select("paper_id").distinct(), "paper_id", "left_anti")
    return extract_blocks(good).unionByName(extract_pages(rest))


def enrich_blocks(blocks: DataFrame, profiles: dict[str, int], *, model: Callable[[str], str] | None = None, model_name: str = "stub") -> DataFrame:
    """``blocks`` with keyword summaries, vectors for each profile (name: dimensions) and, with a model, its summaries."""
    out = E.add_keywords(blocks)
    for name, dim in profiles.items():
        out = E.add_embeddings(out, name, dim)
    if model is not None:
        said = E.rolling_summaries(out.withColumn("title", F.lit("")), model).select("paper_id", "block_id", F.col("summary").alias("__said"))
        joined = out.join(said, ["paper_id", "block_id"], "left")
        out = joined.withColumn("summaries", F.when(F.col("__said").isNotNull(), E.put(F.col("summaries"), f"llm:{model_name}", F.col("__said"))).otherwise(F.col("summaries"))).drop("__said")
    return out


def enrichment_meta(summarizer: str | None, paper_summary: Column, method: str, profiles: dict[str, tuple[str, int]], known: tuple[str, ...]) -> Column:
    """The record of an enrichment: all profiles asked for, models of those that are known."""
    models = [x for name, (m, d) in profiles.items() if name in known for x in (F.lit(name), F.struct(F.lit(m).alias("model"), F.lit(d).alias("dim")))]
    return F.struct(
        F.lit(summarizer).cast("string").alias("summarizer"),
        F.create_map(F.lit(method), paper_summary).alias("paper_summaries"),
        paper_summary.alias("paper_summary"),
        F.array(*map(F.lit, profiles)).cast("array<string>").alias("profiles"),
        F.create_map(*models).cast("map<string,struct<model:string,dim:int>>").alias("embedding_models"),
    )


def skip_existing(files: DataFrame, done: DataFrame, key: str = "pdf_hash") -> DataFrame:
    """Files whose content was not worked off before, whatever their names."""
    return files.join(done.select(key).distinct(), key, "left_anti")


def shared_bundle_valid(file_hash: Column, hashes: Column, title: Column) -> Column:
    """Whether a bundle that lies beside a file belongs to it: the file's hash is among the bundle's, and it has a title."""
    return F.coalesce((F.size(hashes) > 0) & F.array_contains(hashes, file_hash) & T.blank_to_null(T.strip(title)).isNotNull(), F.lit(False))


def ingest_results(files: DataFrame, headers: DataFrame, shared: DataFrame) -> DataFrame:
    """Outcome of each of ``files`` (path, pdf_hash): (path, status, reason, slug). A valid shared bundle (pdf_hash, hashes,
    title, slug) goes the short way, else the extracted header (pdf_hash, verified, ...) must pass the gate."""
    ok = shared.filter(shared_bundle_valid(F.col("pdf_hash"), F.col("hashes"), F.col("title"))).groupBy("pdf_hash").agg(F.min("slug").alias("shared_slug"))
    c = F.col
    joined = files.join(ok, "pdf_hash", "left").join(headers.dropDuplicates(["pdf_hash"]), "pdf_hash", "left")
    gate = F.when(c("verified").isNull() & c("title").isNull(), "no metadata").otherwise(R.rejection(c("verified"), c("verify_warnings"), c("doi"), c("arxiv_id"), c("s2_id"), c("title"), c("slug")))
    reason = F.when(c("shared_slug").isNull(), gate)
    return joined.select("path", F.when(reason.isNull(), "ok").otherwise("failed").alias("status"), reason.alias("reason"), F.coalesce("shared_slug", "slug").alias("slug"))


def tag_updates(papers: DataFrame, old: DataFrame, *, force: bool = False) -> DataFrame:
    """The audit of a tag update of ``papers`` (path, title, authors, doi, year, journal, abstract, keywords) whose files have
    the tags ``old`` (path, identifier, keywords, title, author): decision, message and commands of each, with the old tags and
    the new metadata. Updating copies the file first."""
    c, empty = F.col, F.lit("")
    side = old.select("path", *[F.coalesce(x, empty).alias(f"old_{x}") for x in ("identifier", "keywords", "title", "author")])
    author = F.array_join(F.filter(F.coalesce("authors", F.array().cast("array<string>")), lambda x: x.isNotNull()), "; ")
    joined = papers.join(side, "path", "left")
    decided = joined.withColumn("d", R.update_decision(F.lit(force), c("doi"), c("title"), author, c("old_identifier"), c("old_keywords"), c("old_title"), c("old_author")))
    arguments = M.tag_arguments(c("title"), c("authors"), c("doi"), c("year"), c("journal"), c("abstract"), F.lit(None).cast("string"), c("keywords"))
    return decided.select(
        c("path").alias("pdf_path"), c("d.update").alias("updated"), F.lit(True).alias("success"), c("d.reason").alias("message"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("has_new"),
        *[F.coalesce(x, empty).alias(x) for x in ("old_title", "old_author", "old_identifier", "old_keywords")], empty.alias("old_doi"), F.coalesce("title", empty).alias("new_title"), author.alias("new_author"),
        c("authors").alias("new_authors"), F.coalesce("doi", empty).alias("new_doi"), F.lit("bundle").alias("new_doi_provenance"), c("year").alias("new_year"), F.coalesce("journal", empty).alias("new_journal"),
        F.when(c("d.update"), M.tag_steps(arguments, c("path"))).alias("steps"),
    )


def setting(environment: dict[str, str], configured: dict[str, str], name: str, default: str | None = None) -> str | None:
    """A setting: the environment first, then what is configured."""
    return environment.get(name) or configured.get(name) or default
