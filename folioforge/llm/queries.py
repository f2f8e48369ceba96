"""The queries of this subpackage for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.knn import neighbour_pairs
from folioforge.llm.markup import clean_blocks
from folioforge.llm.mixing import mix_sources
from folioforge.llm.mojibake import pair_counts, records_of, repair_texts
from folioforge.llm.names import link_names, name_pairs
from folioforge.llm.pairs import find_defects
from folioforge.llm.residue import find_residue
from folioforge.llm.scan_noise import repair_blocks
from folioforge.llm.tokens import encode_corpus
from folioforge.llm.unicode_form import canonical_texts
from folioforge.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_defects(table(spark, folder, "blocks"))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return records_of(table(spark, folder, "blocks"), table(spark, folder, "papers"))


def p2_normalized(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    return canonical_texts(records, pair_counts(records))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    # Ligatures and other forms that are brought to one form as well are no cases of the query.
    cases = F.array(*map(F.lit, ("width", "combining", "invisible", "space", "script")))
    return p2_normalized(spark, folder).filter(F.arrays_overlap("changes", cases)).select("record_kind", "record_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "papers").select(F.explode("authors.name").alias("name"))
    return name_pairs(link_names(names))


def p4_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_blocks(table(spark, folder, "blocks"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_clean(spark, folder).select("block_id", F.explode("kinds").alias("markup"))


def p5_repaired(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    return repair_texts(records, pair_counts(records))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_repaired(spark, folder).select("record_kind", "record_id")


def p6_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return repair_blocks(table(spark, folder, "blocks"), table(spark, folder, "papers"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_repaired(spark, folder).select("block_id")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "blocks").select(F.col("block_id").alias("id"), F.col("embeddings")["fine96"].alias("vector"))
    return neighbour_pairs(vectors).select(F.col("a").alias("block_a"), F.col("b").alias("block_b"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p10_residue(spark: SparkSession, folder: str) -> DataFrame:
    return find_residue(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_residue(spark, folder).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_normalized, p3_found, p4_found, p4_clean, p5_found, p5_repaired, p6_found, p6_repaired, p7_found, p8_ids, p9_mix, p9_shares, p10_found, p10_residue)}


def oracle_sql() -> dict[str, str]:
    return {}
