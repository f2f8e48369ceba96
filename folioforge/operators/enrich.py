"""Summaries and embeddings of blocks: what is eligible, pluggable models, upserts into maps, schema migration."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from folioforge.functions import text as T

# Words that end a key phrase.
STOP_WORDS = frozenset("a about above after again against all also although am an and any are as at be because been before being below between both but by can cannot could did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself may me might more most must my no nor not of off on once only or other our out over own same she should so some such than that the their them then there these they this those through to too under until up upon very was we were what when where which while who whom why will with would you your".split())


def summary_eligible(kind: Column, text: Column, least: int = 50) -> Column:
    return ~F.coalesce(kind, F.lit("")).isin(*T.SKIPPED_TYPES) & (F.length(T.strip(F.coalesce(text, F.lit("")))) >= least)


def embed_eligible(kind: Column, text: Column) -> Column:
    return ~F.coalesce(kind, F.lit("")).isin(*T.SKIPPED_TYPES) & (T.strip(F.coalesce(text, F.lit(""))) != "")


def put(entries: Column, key: str, value: Column) -> Column:
    """A map with ``key`` set; other entries stay, null counts as empty."""
    kept = F.map_filter(F.coalesce(entries, F.create_map().cast("map<string,string>")), lambda k, v: k != key)
    return F.map_concat(kept, F.create_map(F.lit(key), value))


def keywords(text: str, most: int = 5) -> str:
    """Key phrases by rapid automatic keyword extraction: runs of words between stop words and punctuation, scored by the sum
    of degree over frequency of their words; the best, ties by their order in the text."""
    phrases = [p for part in re.split(r"[^\w\s'’-]+|\n", text.lower()) for p in _runs(part)]
    frequency: dict[str, int] = defaultdict(int)
    degree: dict[str, int] = defaultdict(int)
    for p in phrases:
        for w in p:
            frequency[w] += 1
            degree[w] += len(p)
    scores: dict[str, float] = {}
    for p in phrases:
        scores.setdefault(" ".join(p), round(sum(degree[w] / frequency[w] for w in p), 9))
    return "; ".join(sorted(scores, key=lambda s: -scores[s])[:most])


def _runs(part: str) -> Iterator[list[str]]:
    run: list[str] = []
    for w in part.split():
        if w in STOP_WORDS or not re.search(r"[^\W\d_]", w):
            if run:
                yield run
            run = []
        else:
            run.append(w)
    if run:
        yield run


@pandas_udf(StringType())
def keyword_summary(texts: pd.Series) -> pd.Series:
    return texts.map(keywords, na_action="ignore")


def add_keywords(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the entry ``rake`` of ``summaries`` set for eligible ones, in one pass: of the others only nulls go to
    Python."""
    ok = F.coalesce(summary_eligible(F.col("type"), F.col("text")), F.lit(False))
    made = blocks.withColumn("__made", keyword_summary(F.when(ok, F.col("text"))))
    return made.withColumn("summaries", F.when(ok, put(F.col("summaries"), "rake", F.col("__made"))).otherwise(F.col("summaries"))).drop("__made")


def hash_embedding(text: str, dim: int) -> list[float]:
    """The default embedder: words hashed to signed places, of length one. Deterministic, for pipelines and tests."""
    v = np.zeros(dim)
    for w in re.findall(r"\w+", text.lower()):
        h = int(hashlib.md5(w.encode(), usedforsecurity=False).hexdigest()[:16], 16)
        v[h % dim] += 1 if h >> 63 else -1
    n = np.linalg.norm(v)
    return (v / n if n else v).astype(np.float32).tolist()


def add_embeddings(blocks: DataFrame, profile: str, dim: int, embedder: Callable[[list[str], int], list[list[float]]] | None = None) -> DataFrame:
    """``blocks`` with the entry ``profile`` of ``embeddings`` set for eligible ones. ``embedder`` gets a batch of texts and is
    built once for each worker; its errors end the job, as a block without a vector would go unnoticed."""
    embed = embedder or (lambda texts, d: [hash_embedding(t, d) for t in texts])

    @pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            asked = texts.notna()
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            out[asked] = pd.Series(list(embed(list(texts[asked]), dim)), index=texts.index[asked], dtype=object)
            yield out

    ok = F.coalesce(embed_eligible(F.col("type"), F.col("text")), F.lit(False))
    kept = F.map_filter(F.coalesce("embeddings", F.create_map().cast("map<string,array<float>>")), lambda k, v: k != profile)
    made = blocks.withColumn("__made", run(F.when(ok, F.col("text"))))
    return made.withColumn("embeddings", F.when(ok, F.map_concat(kept, F.create_map(F.lit(profile), F.col("__made")))).otherwise(F.col("embeddings"))).drop("__made")


def truncate_unit(vector: Column, dim: int) -> Column:
    """The first ``dim`` values, scaled to length one; zero vectors stay."""
    head = F.transform(F.slice(vector, 1, dim), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(head, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm == 0, head).otherwise(F.transform(head, lambda x: x / norm))


def strip_profile(blocks: DataFrame, profile: str) -> DataFrame:
    """``blocks`` without the vectors of a profile, and ``removed``: whether there was one."""
    had = F.coalesce(F.map_contains_key("embeddings", profile), F.lit(False))
    return blocks.withColumn("removed", had).withColumn("embeddings", F.map_filter("embeddings", lambda k, v: k != profile))


def has_model_summary(summaries: Column) -> Column:
    return F.coalesce(F.exists(F.map_keys(summaries), lambda k: k.startswith("llm:")), F.lit(False))


def migrate_summaries(blocks: DataFrame) -> DataFrame:
    """``blocks`` of the old form (``summary``) in the new one (``summaries``), and ``migrated``. The new form stays as it is,
    with ``summary`` beside it; doing it again changes nothing."""
    old = F.col("summaries").isNull()
    made = F.when(T.blank_to_null(F.col("summary")).isNotNull(), F.create_map(F.lit("llm:unknown"), F.col("summary"))).otherwise(F.create_map().cast("map<string,string>"))
    return blocks.withColumns({"migrated": old, "summary": F.when(~old, F.col("summary")), "summaries": F.when(old, made).otherwise(F.col("summaries"))})


def migrate_meta(meta: Column) -> Column:
    """A record of enrichment (paper_summary, paper_summaries, ...) of the old form in the new one: the summary of the paper
    becomes an entry of ``paper_summaries`` unless there are such; doing it again changes nothing."""
    old = T.blank_to_null(meta["paper_summary"])
    bare = F.coalesce(F.size(meta["paper_summaries"]), F.lit(0)) <= 0
    moved = F.create_map(F.lit("llm:unknown"), old)
    return F.when(old.isNotNull() & bare, meta.withField("paper_summaries", moved)).otherwise(meta)


def migration_counts(before: DataFrame, after: DataFrame, key: str = "paper_id") -> DataFrame:
    """(key, raked_before, raked_after) of the blocks with key phrases before and after a migration."""
    raked = F.count_if(T.blank_to_null(F.col("summaries")["rake"]).isNotNull())
    return before.groupBy(key).agg(raked.alias("raked_before")).join(after.groupBy(key).agg(raked.alias("raked_after")), key)


def stub_model(prompt: str) -> str:
    """The default model: the first sentence of the last line."""
    line = prompt.strip().split("\n")[-1]
    return re.split(r"(?<=[.!?])\s", line)[0][:200]


def rolling_summaries(blocks: DataFrame, model: Callable[[str], str] = stub_model, *, key: str = "paper_id") -> DataFrame:
    """(key, block_id, summary) in document order, each prompt with the last summary that was made: a true recurrence.

    The work of a document is sequential by its nature; its rows stream through a sorted partition and are never gathered, so
    a large document needs time but no memory. A model that fails leaves its block without a summary.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        document, last = None, ""
        for batch in batches:
            rows = []
            for paper, block, title, text in zip(batch["key"], batch["block_id"], batch["title"], batch["text"], strict=True):
                if paper != document:
                    document, last = paper, ""
                prompt = "\n".join(x for x in (f"Title: {title}" if title else "", f"Previous: {last}" if last else "", text[:2000]) if x)
                try:
                    said = model(prompt)
                except Exception:
                    continue
                last = said or last
                rows.append((paper, block, said))
            yield pd.DataFrame(rows, columns=["key", "block_id", "summary"])

    ok = blocks.filter(summary_eligible(F.col("type"), F.col("text"))).select(F.col(key).alias("key"), "pos", "block_id", F.coalesce("title", F.lit("")).alias("title"), "text")
    ordered = ok.repartition("key").sortWithinPartitions("key", "pos", "block_id")
    return ordered.mapInPandas(run, "key string, block_id long, summary string").withColumnRenamed("key", key)


def paper_digest(blocks: DataFrame, method: str = "rake", *, key: str = "paper_id", most: int = 4000, lines: int = 400) -> DataFrame:
    """(key, digest): the summaries of a document's blocks as lines in order, cut to ``most`` characters.

    As no more than ``most`` characters are kept and a line has three at least, the first ``lines`` blocks with a summary
    decide; they are picked before anything is gathered.
    """
    from pyspark.sql import Window

    said = blocks.withColumn("__s", F.col("summaries")[method]).filter(T.blank_to_null(F.col("__s")).isNotNull())
    picked = said.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("pos", "block_id"))).filter(F.col("__n") <= max(lines, most // 3))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__s"))), lambda x: F.concat(F.lit("- "), x["__s"])), "\n")
    return picked.groupBy(key).agg(F.substring(text, 1, most).alias("digest"))
