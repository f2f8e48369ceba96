"""Bundles (gzipped JSON documents), sidecars, images and logs: readers and writers."""

from __future__ import annotations

import gzip
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.schema import AUDIT, BLOCK, BUNDLE

# MIME types by suffix.
MIME = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "svg": "image/svg+xml"}
JPEG_FROM = 500_000
#: Suffix of bundle files; that of existing bundles is passed in.
SUFFIX = ".bundle"


def scan(spark: SparkSession, folder: str, glob: str, *, recursive: bool = True) -> DataFrame:
    """Paths, times and sizes of files; contents are read only where a later step asks for them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)


def scan_pdfs(spark: SparkSession, target: str, *, recursive: bool = True) -> DataFrame:
    """A file is taken whatever the case of its suffix, in folders only ``*.pdf``."""
    if target.lower().endswith(".pdf"):
        return spark.read.format("binaryFile").load(target)
    return scan(spark, target, "*.pdf", recursive=recursive)


def read_bundles(spark: SparkSession, folder: str, suffix: str = SUFFIX) -> DataFrame:
    """(path, header, blocks, enrichment_meta, error) of all bundles below a folder; both forms of blocks are read.

    What is no gzip or no JSON has an error and nulls, and ends nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows.append((path, gzip.decompress(content).decode("utf-8"), None))
                except (OSError, EOFError, UnicodeDecodeError) as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "json", "error"])

    raw = scan(spark, folder, f"*{suffix}").select("path", "content").mapInPandas(run, "path string, json string, error string")
    parsed = raw.withColumn("b", F.when(F.try_parse_json("json").isNotNull(), F.from_json("json", BUNDLE)))
    error = F.coalesce("error", F.when(F.col("b").isNull(), F.lit("no JSON object")))
    return parsed.select("path", "b.header", "b.blocks", "b.enrichment_meta", error.alias("error"))


def bundle_json(header: Column, blocks: Column, meta: Column) -> Column:
    """The text of a bundle: compact JSON, nulls kept, other scripts as they are."""
    return F.to_json(F.struct(header.alias("header"), blocks.alias("blocks"), meta.alias("enrichment_meta")), {"ignoreNullFields": "false"})


def assemble(papers: DataFrame, blocks: DataFrame, *, key: str = "paper_id") -> DataFrame:
    """(key, json): one bundle for each paper. A bundle is one JSON document by its definition, so the blocks of a paper are
    gathered in one row here and nowhere else; papers with too many blocks for that are kept as tables instead."""
    names = [f.name for f in BLOCK.fields]
    have = [F.col(n) if n in blocks.columns else F.lit(None).cast(BLOCK[n].dataType).alias(n) for n in names]
    listed = blocks.select(key, "pos", "block_id", F.struct(*have).alias("b")).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "block_id", F.to_json("b").alias("j")))), lambda x: F.from_json(x.j, BLOCK)).alias("blocks"))
    header = F.struct(*[c for c in papers.columns if c not in ("bundle_id",)])
    return papers.select(key, header.alias("header")).join(listed, key, "left").select(key, bundle_json(F.col("header"), F.coalesce("blocks", F.array().cast(T.ArrayType(BLOCK))), F.lit(None).cast("string")).alias("json"))


def write_bundles(bundles: DataFrame, folder: str, suffix: str = SUFFIX) -> None:
    """Writes ``bundles`` (name, json), each to <folder>/<name><suffix>: by its tasks, each file whole under another name first,
    so that a task that is run again leaves no half file. ``folder`` is a path or address that all executors share."""

    def run(rows: Iterator) -> None:
        from pyarrow import fs as F

        system, root = F.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
        for r in rows:
            path = f"{root.rstrip('/')}/{r['name']}{suffix}"
            system.create_dir(path.rpartition("/")[0], recursive=True)
            part = f"{path}.{os.getpid()}.part"
            with system.open_output_stream(part, compression=None) as out:
                out.write(gzip.compress(r["json"].encode("utf-8")))
            system.move(part, path)

    bundles.select("name", "json").foreachPartition(run)


def audit_line(c: Callable[[str], Column] = F.col) -> Column:
    """One line of an audit as JSON: the outcome, the old tags and the new metadata as objects of their own (null where nothing
    was written)."""
    new = F.struct(*[c(f"new_{n}").alias(n) for n in ("title", "authors", "doi", "doi_provenance", "year", "journal")])
    old = F.struct(*[c(f"old_{n}").alias(n) for n in ("title", "author", "identifier", "keywords")])
    line = F.struct(*[c(n).alias(n) for n in ("timestamp", "pdf_path", "success", "updated", "message", "error")], old.alias("old_metadata"), F.when(c("has_new"), new).alias("new_metadata"))
    return F.to_json(line, {"ignoreNullFields": "false"})


def write_audit(results: DataFrame, path: str) -> None:
    """An audit of tag updates: CSV of ten columns for a path that ends so, else JSON lines with nested metadata. The values of
    CSV are quoted, so that blanks and line ends within them stay."""
    if path.lower().endswith(".csv"):
        flat = results.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in AUDIT])
        flat.write.mode("overwrite").options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        results.select(audit_line().alias("line")).write.mode("overwrite").text(path)


def append_log(lines: DataFrame, folder: str) -> None:
    lines.select("line").write.mode("append").text(folder)


def mime_of(path: Column) -> Column:
    suffix = F.lower(F.substring_index(path, ".", -1))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), suffix), F.lit("image/png"))


def encode_image(content: Column) -> Column:
    """Base64 on one line."""
    return F.regexp_replace(F.base64(content), r"[\r\n]", "")


def image_format(width: Column, height: Column) -> Column:
    """Large images are kept as JPEG, others as PNG."""
    return F.when(width.cast("long") * height > JPEG_FROM, "image/jpeg").otherwise("image/png")


def join_images(refs: DataFrame, images: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, image): for each reference (key, pos, ref) the image (key, image_pos, name) of that name, else the first one
    whose name contains the last part of the reference or is contained in it. A document's images come as one array."""
    lists = images.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("image_pos", "name"))).alias("images"))
    last = F.substring_index("ref", "/", -1)
    exact = F.filter("images", lambda x: x["name"] == F.col("ref"))
    loose = F.filter("images", lambda x: x["name"].contains(last) | last.contains(x["name"]))
    return refs.join(lists, key, "left").select(key, "pos", F.coalesce(F.get(exact, F.lit(0))["name"], F.get(loose, F.lit(0))["name"]).alias("image"))


def failover(primary: DataFrame, fallback: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``primary`` without an error; for documents that have none there, those of ``fallback``."""
    good = primary.filter("error is null")
    return good.unionByName(fallback.join(good.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)
