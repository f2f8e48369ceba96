"""Upkeep of papers: hash histories, merges of metadata, tag commands, rename plans, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators.resolve import first_filled

# Header fields that newly found metadata overwrite.
UPDATED = ("title", "year", "doi", "journal", "abstract", "entry_type", "arxiv_id", "s2_id")


def valid_hashes(original: Column, history: Column) -> Column:
    """The original hash and those of the history, in order, without repeats and empty ones."""
    every = F.concat(F.array(original), F.coalesce(history, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(every, lambda x: x.isNotNull() & (x != "")))


def append_hash(original: Column, history: Column, new: Column) -> Column:
    """Struct (history, changed) with a new hash; an empty history begins with the original one."""
    known = F.when(F.size(F.coalesce(history, F.array().cast("array<string>"))) > 0, history).otherwise(F.filter(F.array(original), lambda x: x.isNotNull() & (x != "")))
    changed = ~F.array_contains(known, new)
    return F.struct(F.when(changed, F.concat(known, F.array(new))).otherwise(known).alias("history"), changed.alias("changed"))


def hash_histories(papers: DataFrame, *, key: str = "paper_id") -> DataFrame:
    """(key, first_hash, hashes): all hashes of a paper, in the order of its extractions (bundle_id), without repeats.

    Repeats go before anything is gathered; a paper has as many hashes as different files, and its history is one value by its
    definition.
    """
    first = papers.filter(T.blank_to_null(F.col("pdf_hash")).isNotNull()).groupBy(key, "pdf_hash").agg(F.min("bundle_id").alias("at"))
    listed = first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "pdf_hash"))), lambda x: x.pdf_hash).alias("hashes"))
    return listed.select(key, F.get("hashes", F.lit(0)).alias("first_hash"), "hashes")


def update_metadata(headers: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """``headers`` with the fields of ``found`` that are filled there."""
    new = found.select(on, *[F.col(c).alias(f"__{c}") for c in UPDATED if c in found.columns])
    joined = headers.join(new, on, "left")

    def merged(c: str) -> Column:
        text = headers.schema[c].dataType.simpleString() == "string"
        return first_filled(F.col(f"__{c}"), F.col(c)) if text else F.coalesce(f"__{c}", c)

    return joined.withColumns({c: merged(c) for c in UPDATED if c in found.columns}).drop(*[f"__{c}" for c in UPDATED])


def tag_arguments(title: Column, authors: Column, doi: Column, year: Column, journal: Column, abstract: Column, publisher: Column, keywords: Column) -> Column:
    """Arguments that write a paper's tags, in order; empty ones are left out."""
    has = lambda c: T.blank_to_null(c)
    names = F.filter(F.coalesce(authors, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    subject = has(F.concat_ws(", ", has(journal), year.cast("string")))
    words = F.concat(F.filter(F.array(has(doi)), lambda x: x.isNotNull()), F.filter(F.coalesce(keywords, F.array().cast("array<string>")), lambda x: (x != "") & (F.coalesce(doi, F.lit("")) != x)))
    one = lambda tag, c: F.filter(F.array(F.concat(F.lit(f"-{tag}="), c)), lambda x: x.isNotNull())
    return F.concat(
        one("Title", has(title)),
        one("Author", has(F.array_join(names, "; "))),
        one("Subject", subject),
        one("Keywords", has(F.array_join(words, ", "))),
        one("XMP-dc:Identifier", F.concat(F.lit("doi:"), has(doi))),
        F.transform(names, lambda n: F.concat(F.lit("-XMP-dc:Creator="), n)),
        one("XMP-dc:Publisher", has(publisher)),
        one("XMP-dc:Date", year.cast("string")),
        one("XMP-dc:Title", has(title)),
        one("XMP-dc:Description", F.substring(has(abstract), 1, 2000)),
    )


def tag_command(arguments: Column, path: Column, tool: str = "exiftool") -> Column:
    return F.concat(F.array(F.lit(tool), F.lit("-overwrite_original"), F.lit("-P")), arguments, F.array(path))


def backup_plan(files: DataFrame, tool: str = "cp") -> DataFrame:
    """(path, backup, command) of ``files`` (path): the copy beside each file that is made before its tags are written; an older
    copy is overwritten."""
    backup = F.concat("path", F.lit(".bak"))
    return files.select("path", backup.alias("backup"), F.array(F.lit(tool), F.lit("-p"), F.col("path"), backup).alias("command"))


def tag_steps(arguments: Column, path: Column, *, tool: str = "exiftool", copy: str = "cp") -> Column:
    """The commands that write a file's tags, in order: its copy, then the tags."""
    return F.array(F.array(F.lit(copy), F.lit("-p"), path, F.concat(path, F.lit(".bak"))), tag_command(arguments, path, tool))


def error_record(path: Column, at: Column, error: Column, trace: Column) -> Column:
    """Struct (path, body): the text file that is put beside a file that failed."""
    target = F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit(".error.txt"))
    none = F.lit("")
    body = F.concat(F.lit("PDF: "), F.substring_index(path, "/", -1), F.lit("\nTime: "), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("\nError: "), F.coalesce(error, none), F.lit("\n\nTraceback:\n"), F.coalesce(trace, none))
    return F.struct(target.alias("path"), body.alias("body"))


def error_records(failed: DataFrame) -> DataFrame:
    """(path, body) of the records of ``failed`` (path, at, error, trace)."""
    return failed.select(error_record(F.col("path"), F.col("at"), F.col("error"), F.col("trace")).alias("e")).select("e.path", "e.body")


def log_line(ts: Column, user: Column, slug: Column, doi: Column, filename: Column, ref_id: Column, title: Column) -> Column:
    """One line of the ingest log; tabs and line ends within values become blanks, missing values nothing."""
    cells = [F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), user, slug, doi, filename, ref_id.cast("string"), title]
    return F.concat_ws("\t", *[F.coalesce(F.regexp_replace(c, r"[\t\r\n]+", " "), F.lit("")) for c in cells])


def layout(slug: Column, *, shared: bool = False) -> Column:
    """Folder of a paper: papers/<first letter>/<slug>."""
    letter = F.substring(slug, 1, 1)
    first = F.coalesce(T.blank_to_null(F.lower(letter)), F.lit("_")) if shared else F.coalesce(T.blank_to_null(letter), F.lit("x"))
    return F.concat_ws("/", F.lit("papers"), first, F.coalesce(slug, F.lit("")))


def repair_target(stem: Column) -> Column:
    return F.coalesce(stem.rlike("(?i)anon|untitled"), F.lit(False))


def rename_plan(files: DataFrame) -> DataFrame:
    """(path, target, conflict) of ``files`` (path, new_stem): no file takes the name of another that exists or that another
    file takes; of several that want a name the smallest path gets it."""
    target = F.concat(F.regexp_replace("path", "[^/]*$", ""), F.col("new_stem"), F.regexp_extract("path", r"(\.[^./]*)?$", 0))
    wanted = files.select("path", target.alias("target"))
    first = wanted.groupBy("target").agg(F.min("path").alias("first"))
    there = wanted.select(F.col("path").alias("target"), F.lit(True).alias("there")).distinct()
    judged = wanted.join(first, "target").join(there, "target", "left")
    return judged.select("path", "target", ((F.coalesce("there", F.lit(False)) & (F.col("path") != F.col("target"))) | (F.col("path") != F.col("first"))).alias("conflict"))


def conflict_names(moves: DataFrame) -> DataFrame:
    """(path, dest) of ``moves`` (path, folder, stamp): files that would meet get the stamp before the suffix, and numbers from
    the third on."""
    name = F.substring_index("path", "/", -1)
    w = Window.partitionBy("folder", "name").orderBy("path")
    numbered = moves.withColumn("name", name).withColumn("n", F.row_number().over(w))
    stem, suffix = F.regexp_replace("name", r"\.[^.]*$", ""), F.regexp_extract("name", r"\.[^.]*$", 0)
    stamped = F.concat(stem, F.lit("_"), "stamp", F.when(F.col("n") > 2, F.concat(F.lit("_"), (F.col("n") - 1).cast("string"))).otherwise(""), suffix)
    return numbered.select("path", F.concat("folder", F.lit("/"), F.when(F.col("n") == 1, F.col("name")).otherwise(stamped)).alias("dest"))


def report(results: DataFrame) -> DataFrame:
    """Counts of results (success, updated): a dry run counts as skipped."""
    ok, new = F.coalesce("success", F.lit(False)), F.coalesce("updated", F.lit(False))
    return results.agg(F.count("*").alias("total"), F.count_if(ok & new).alias("updated"), F.count_if(ok & ~new).alias("skipped"), F.count_if(~ok).alias("failed"))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the greatest ``order``; a maximum by a struct, computed partially before the shuffle."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.col(order)).alias("r")).select(key, "r.*")


def first_of_copies(df: DataFrame, value: str, order: str) -> DataFrame:
    """``df`` with ``digest`` of ``value``, the first row (``first_id``) of its copies and their number."""
    hashed = df.withColumn("digest", F.sha2(F.col(value), 256))
    groups = hashed.filter("digest is not null").groupBy("digest").agg(F.min(order).alias("first_id"), F.count("*").alias("copies"))
    return hashed.select(order, "digest").join(groups, "digest")
