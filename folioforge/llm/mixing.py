"""Mixing sources to target shares of all tokens (problem 9).

Method: Sainte-Lague apportionment. The mix is made of equal-token blocks. The blocks are first apportioned among the sources
by highest quotients ``share / (2 k + 1)``, then each source's blocks among its shards in proportion to their tokens, so
that every shard gets an integer quota and can be filled without looking at any other. Within a shard the documents stand
in a seeded order and are used from its start: whole passes first, then the blocks that remain of the quota. The document
that crosses a quota's end is used if its middle lies before it, so that the error averages out; it is at most half a
document for each shard.

The size of the mix is, by default, the largest at which every source that has documents can reach its share with no
document used more than ``max_repeats`` times. A target source without documents can reach nothing; its share is divided
among the others, and the report shows both.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.tokens import count_tokens
from folioforge.session import checkpointed


@dataclass(frozen=True)
class MixPlan:
    """``block_tokens`` is the apportioned unit. A shard holds about ``shard_tokens`` tokens, but all sources together have no
    more than ``max_shards`` shards (and one each), divided among them by their tokens: this bounds what the driver gets, while
    the sort of a shard can spill. Tables of up to ``most_rows`` rows are broadcast, larger ones joined."""

    block_tokens: int = 256
    shard_tokens: int = 4_000_000
    max_shards: int = 20_000
    most_rows: int = 100_000
    size_tokens: int | None = None
    seed: int = 17


def sainte_lague(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotients w / (2 k + 1), none above its cap; equal quotients go to the first.

    The bulk is given at once for a divisor found by bisection, the rest one by one from a heap.
    """
    seats = min(seats, sum(c for w, c in zip(weights, caps, strict=True) if w > 0))
    low, high = 0.0, 1.0

    def given(scale: float) -> list[int]:
        return [min(c, math.floor(w * scale + 0.5)) if w > 0 else 0 for w, c in zip(weights, caps, strict=True)]

    while sum(given(high)) < seats:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(given(middle)) <= seats else (low, middle)
    out = given(low * (1 - 1e-9))  # just below, so that equal quotients are all left to the heap
    heap = [(-w / (2 * k + 1), i) for i, (w, k, c) in enumerate(zip(weights, out, caps, strict=True)) if w > 0 and k < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def _targets(targets: DataFrame, plan: MixPlan) -> dict[str, tuple[float, int]]:
    """Share and repeats of each target source. Null sources, and null, not finite or non-positive shares, are no targets; of
    repeated rows the shares are added and the smaller number of repeats holds; null repeats mean 1."""
    share = F.col("target_share").cast("double")
    rows = (
        targets.filter(F.col("source").isNotNull() & share.isNotNull() & ~F.isnan(share) & (share > 0) & (share < float("inf")))
        .groupBy("source")
        .agg(F.sum(share).alias("share"), F.min(F.greatest(F.coalesce(F.col("max_repeats"), F.lit(1)), F.lit(0))).alias("repeats"))
        .orderBy("source")
        .collect()
    )
    return {r["source"]: (r["share"], int(r["repeats"])) for r in rows}


def mix_sources(documents: DataFrame, targets: DataFrame, *, plan: MixPlan | None = None, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix (doc_id, source, n_tokens, copies) and its report (source, target_share, mixed_share, actual_share, tokens, documents, repeats).

    Documents without tokens (null, empty) or of a source without a target are not used. Empty inputs give an empty mix and
    a report of zeros; repeated documents are documents of their own.
    """
    plan = plan or MixPlan()
    spark = documents.sparkSession
    wanted = _targets(targets, plan)
    report_type = "source string, target_share double, mixed_share double"
    known = spark.createDataFrame([(s, share, n) for s, (share, n) in wanted.items()], "source string, share double, max_repeats int")
    small = lambda df, n: F.broadcast(df) if n <= plan.most_rows else df
    counted = count_tokens(documents.select("doc_id", "source", "text").join(small(known, len(wanted)), "source", "left_semi"), keys=["doc_id", "source"], path=path)
    counted = checkpointed(counted.filter(F.col("n_tokens") > 0))
    totals = {r["source"]: r["t"] for r in counted.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    present = [s for s in wanted if totals.get(s, 0) * wanted[s][1] > 0]
    whole = sum(wanted[s][0] for s in present) or 1.0
    share = {s: wanted[s][0] / whole for s in present}
    everything = sum(totals[s] for s in present)
    shards = {s: max(1, min(plan.max_shards * totals[s] // max(1, everything), math.ceil(totals[s] / plan.shard_tokens))) for s in present}

    parts = spark.createDataFrame([(s, n) for s, n in shards.items()], "source string, n_shards int")
    placed = counted.join(small(parts, len(shards)), "source").withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(plan.seed)), F.col("n_shards")).cast("int"))
    sizes = {(r["source"], r["shard"]): r["t"] for r in placed.groupBy("source", "shard").agg(F.sum("n_tokens").alias("t")).collect()}

    reachable = min([totals[s] * wanted[s][1] / share[s] for s in present], default=0.0)
    size = reachable if plan.size_tokens is None else min(plan.size_tokens, sum(totals[s] * wanted[s][1] for s in present))
    order = sorted(present)
    quota = dict(zip(order, sainte_lague([share[s] for s in order], int(size // plan.block_tokens), [totals[s] * wanted[s][1] // plan.block_tokens for s in order]), strict=True))
    fills = []
    for s in order:
        own = sorted(k for k in sizes if k[0] == s)
        # A shard's last, incomplete block can be given too; what it lacks is less than a block.
        caps = [-(-sizes[k] * wanted[s][1] // plan.block_tokens) for k in own]
        for k, blocks in zip(own, sainte_lague([float(sizes[k]) for k in own], quota[s], caps), strict=True):
            tokens = min(blocks * plan.block_tokens, sizes[k] * wanted[s][1])
            fills.append((s, k[1], tokens // sizes[k], tokens % sizes[k]))

    filled = spark.createDataFrame(fills, "source string, shard int, passes long, rest long")
    seeded = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(plan.seed + 1)), "doc_id", "n_tokens")
    before = F.sum("n_tokens").over(seeded.rowsBetween(Window.unboundedPreceding, -1))
    mix = (
        placed.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(small(filled, len(fills)), ["source", "shard"])
        .withColumn("copies", (F.col("passes") + F.when(F.col("before") + F.col("n_tokens") / 2 <= F.col("rest"), 1).otherwise(0)).cast("int"))
        .filter(F.col("copies") > 0)
        .select("doc_id", "source", "n_tokens", "copies")
    )
    used = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("repeats"))
    goals = spark.createDataFrame([(s, v[0], share.get(s, 0.0)) for s, v in wanted.items()], T._parse_datatype_string(report_type))
    report = goals.join(used, "source", "left").select(
        "source",
        "target_share",
        "mixed_share",
        F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy(F.lit(1))), F.lit(0)), F.lit(0.0)).alias("actual_share"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("tokens", "documents", "repeats")],
    )
    return mix, report
