"""The k most similar vectors of every vector, by learned partitions (problem 7).

Method. From a bounded sample (``sample_rows``) a neighbour graph is built, the graph is cut into balanced partitions, and a
small classifier (multinomial logistic regression) learns which partition a vector's neighbours lie in. Every vector is
indexed in its most probable partition and, as a query, visits the ``probes`` most probable ones, where all similarities are
computed exactly in double precision; the best k of all visited partitions stay. Only the partitions and the classifiers come
from samples; every row is indexed and every row is a query.

Size. Partitions hold about ``partition_rows`` rows whatever the table's size, so the work grows in proportion to it. Where
more than ``fan_out`` partitions are needed, each partition of a level is cut again, by a graph and a classifier of its own
fitted from a sample of its own rows, in the executors; a vector descends the tree along the ``probes`` most probable paths.
The tree is broadcast while it has at most ``most_leaves`` leaves; beyond, the vectors meet the classifiers of each level in
a grouping by node, with the same result.

Skew. A vector that occurs more than k + 1 times is indexed by its k + 1 smallest ids only: the others can never be among
the neighbours, as ties go to the smaller id. A partition with more than ``block_rows`` index rows or queries is split into
blocks of both; each query block meets each index block, so nothing is dropped and no task grows with a partition. As
partitions do not grow with the table, only true skew makes blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import bounded_sample, checkpointed


@dataclass(frozen=True)
class KnnPlan:
    """``partition_rows``: index rows meant for a partition. ``sample_rows``: rows at most from which one classifier is fitted.
    ``fan_out``: partitions at most of one classifier. ``most_leaves``: leaves at most of a tree that is broadcast, and rows at
    most of other tables that are; what is larger is joined."""

    k: int = 10
    dim: int = 96
    probes: int = 4
    sample_rows: int = 16_384
    partition_rows: int = 1000
    fan_out: int = 512
    block_rows: int = 4096
    most_leaves: int = 65_536
    task_mb: int = 8
    digits: int = 9
    seed: int = 7

    #: Sampled rows for each partition that is learned.
    per_part: int = 32


def usable(vector: str, dim: int):
    """``dim`` finite values that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0)


# --- fitting, on the bounded sample -------------------------------------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each unit vector the row numbers of its k nearest others."""
    out = np.empty((len(x), k), dtype=np.int32)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
        out[at : at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, seed: int, rounds: int = 8) -> np.ndarray:
    """A part for each row, of at most 1.1 times the mean size, with few edges of the graph between parts.

    Starts from directions (spherical means) and then moves rows to the part most of their neighbours are in, while there is
    room; full parts give rows with the least ties first.
    """
    rng = np.random.default_rng(seed)
    room = int(np.ceil(len(x) / parts * 1.1))
    centres = x[rng.choice(len(x), parts, replace=False)]
    near = np.zeros(len(x), dtype=np.int64)
    for _ in range(8):
        near = np.concatenate([(x[at : at + 4096] @ centres.T).argmax(1) for at in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        empty = np.flatnonzero(np.bincount(near, minlength=parts) == 0)
        sums[empty] = x[rng.choice(len(x), len(empty))]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    part = near
    for turn in range(rounds):
        votes = np.zeros((len(x), parts), dtype=np.float32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
        votes += 2.0 * (x @ centres.T)  # the direction decides where neighbours do not
        wish = votes.argmax(1)
        gain = votes[np.arange(len(x)), wish] - votes[np.arange(len(x)), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain):
            if gain[i] <= 0:
                break
            if size[wish[i]] < room:
                size[part[i]] -= 1
                size[wish[i]] += 1
                part[i] = wish[i]
                moved += 1
        if turn == rounds - 1 or not moved:  # what is still too full gives away its loosest rows
            for p in np.flatnonzero(size > room):
                own = np.flatnonzero(part == p)
                for i in own[np.argsort(votes[own, p])][: size[p] - room]:
                    free = np.where(size < room, votes[i], -np.inf).argmax()
                    part[i] = free
                    size[free] += 1
            break
    return part


def fit_router(x: np.ndarray, part: np.ndarray, parts: int, seed: int, epochs: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial logistic regression from a unit vector to its part."""
    rng = np.random.default_rng(seed)
    w = np.zeros((x.shape[1], parts), dtype=np.float32)
    np.add.at(w.T, part, x)
    w *= 12.0 / np.maximum(np.linalg.norm(w, axis=0, keepdims=True), 1e-9)
    b = np.zeros(parts, dtype=np.float32)
    for epoch in range(epochs):
        rate = 2.0 / (1 + epoch)
        order = rng.permutation(len(x))
        for at in range(0, len(x), 512):
            i = order[at : at + 512]
            z = x[i] @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(i)), part[i]] -= 1
            w -= rate * (x[i].T @ p) / len(i) * 8
            b -= rate * p.mean(0)
    return w, b


def fit_partitions(x: np.ndarray, parts: int, plan: KnnPlan) -> tuple[np.ndarray, np.ndarray]:
    """Router of ``parts`` partitions learned from unit vectors ``x``; with one partition there is nothing to learn."""
    parts = max(1, min(parts, len(x)))
    if parts == 1:
        return np.zeros((plan.dim, 1), np.float32), np.zeros(1, np.float32)
    graph = neighbour_graph(x, min(10, len(x) - 1))
    return fit_router(x, balanced_partitions(x, graph, parts, plan.seed), parts, plan.seed)


# --- the tree of classifiers ------------------------------------------------------------------------------------------------


Router = tuple[np.ndarray, np.ndarray]


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float64)
    return (y / np.linalg.norm(y, axis=1, keepdims=True)).astype(np.float32)


def child(node, number, plan: KnnPlan):
    """The id of a node's child; the root is 0."""
    return node * (plan.fan_out + 1) + number + 1


def _children(x: np.ndarray, router: Router, take: int) -> tuple[np.ndarray, np.ndarray]:
    """(log probability, number) of the ``take`` most probable children for each row."""
    z = x @ router[0] + router[1]
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    take = min(take, z.shape[1])
    best = np.argpartition(-z, take - 1, axis=1)[:, :take]
    return np.take_along_axis(z, best, 1), best


def _best(score: np.ndarray, node: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``take`` best of each row, best first, equal ones by node."""
    order = np.lexsort((node, -score), axis=1)[:, :take]
    return np.take_along_axis(score, order, 1), np.take_along_axis(node, order, 1)


def expand(x: np.ndarray, score: np.ndarray, node: np.ndarray, routers: dict[int, Router], plan: KnnPlan) -> tuple[np.ndarray, np.ndarray]:
    """One level down: the best paths of each row after every node that has a classifier was replaced by its children."""
    b = node.shape[1]
    scores = np.full((len(x), b * plan.probes), -np.inf, np.float32)
    nodes = np.full(scores.shape, -1, np.int64)
    for j in range(b):
        order = np.argsort(node[:, j], kind="stable")
        own, starts = np.unique(node[order, j], return_index=True)
        for u, lo, hi in zip(own, starts, [*starts[1:], len(order)], strict=True):
            rows, at = order[lo:hi], j * plan.probes
            if u in routers:
                s, c = _children(x[rows], routers[u], plan.probes)
                scores[rows, at : at + s.shape[1]] = s + score[rows, j : j + 1]
                nodes[rows, at : at + s.shape[1]] = child(int(u), c.astype(np.int64), plan)
            elif u >= 0:
                scores[rows, at], nodes[rows, at] = score[rows, j], u
    return _best(scores, nodes, plan.probes)


def _levels(n: int, plan: KnnPlan) -> list[int]:
    """Rows meant for a partition, level by level."""
    leaves = max(1, -(-n // plan.partition_rows))
    depth = 1
    while plan.fan_out**depth < leaves:
        depth += 1
    fan = max(1, int(np.ceil(leaves ** (1 / depth) - 1e-9)))
    return [plan.partition_rows * fan ** (depth - 1 - i) for i in range(depth)]


_ROUTER = "node long, weights array<float>, bias array<float>"
_STATE = "array<struct<loss: float, node: long>>"


def _router_of(row: dict, plan: KnnPlan) -> Router:
    return np.asarray(row["weights"], np.float32).reshape(plan.dim, -1), np.asarray(row["bias"], np.float32)


def _fit_level(routed: DataFrame, rows_each: int, plan: KnnPlan) -> DataFrame:
    """Classifiers (node, weights, bias) of the nodes that ``routed`` (id, vector, state) has reached: each is fitted from a
    sample of the vectors whose best path ends there, in proportion to their number and bounded by ``sample_rows``."""
    share = min(1.0, plan.per_part / rows_each)
    rank = F.xxhash64("id", F.lit(plan.seed + 2))
    picked = routed.filter(F.shiftrightunsigned(rank, 11) < int(share * (1 << 53))).select(F.col("state")[0]["node"].alias("node"), "vector", rank.alias("rank"))
    most = min(plan.sample_rows, plan.per_part * plan.fan_out)
    bounded = picked.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("rank"))).filter(F.col("n") <= most)

    def run(group: pa.Table) -> pa.Table:
        x = _unit(_matrix(group.column("vector").combine_chunks(), plan.dim)[np.argsort(group.column("rank").to_numpy())])
        parts = min(plan.fan_out, round(len(x) / plan.per_part))
        router = fit_partitions(x, parts, plan) if parts > 1 else None
        rows = [] if router is None else [(group.column("node")[0].as_py(), router[0].ravel().tolist(), router[1].tolist())]
        return pa.table({"node": pa.array([r[0] for r in rows], pa.int64()), "weights": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "bias": pa.array([r[2] for r in rows], pa.list_(pa.float32()))})

    return bounded.select("node", "vector", "rank").groupBy("node").applyInArrow(run, _ROUTER)


def _descend(rows: DataFrame, routers: dict[int, Router], depth: int, plan: KnnPlan, kept: list[str]) -> DataFrame:
    """``rows`` (id, vector, ``kept``) with their state after ``depth`` levels of a broadcast tree."""
    shared = rows.sparkSession.sparkContext.broadcast(routers)  # at most most_leaves leaves
    types = [rows.schema[c].dataType.simpleString() for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column(1), plan.dim))
            score, node = np.zeros((len(x), 1), np.float32), np.zeros((len(x), 1), np.int64)
            for _ in range(depth):
                score, node = expand(x, score, node, shared.value, plan)
            yield pa.RecordBatch.from_arrays([*batch.columns, _states(score, node)], names=["id", "vector", *kept, "state"])

    return rows.select("id", "vector", *kept).mapInArrow(run, ", ".join(["id long, vector array<float>", *(f"{c} {t}" for c, t in zip(kept, types, strict=True)), f"state {_STATE}"]))


def _states(score: np.ndarray, node: np.ndarray) -> pa.ListArray:
    real = node >= 0
    ends = np.concatenate([[0], np.cumsum(real.sum(1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(-score[real]), pa.array(node[real])], names=["loss", "node"]))


def _descend_joined(routed: DataFrame, routers: DataFrame, plan: KnnPlan, kept: list[str]) -> DataFrame:
    """One level of a tree too large to broadcast: vectors and classifiers meet in groups of (node, salt) of bounded size; the
    paths that end at a leaf already stay as they are."""
    each = routed.select("id", "vector", F.explode("state").alias("s")).select("id", "vector", "s.loss", "s.node")
    sizes = each.groupBy("node").agg(F.ceil(F.count("*") / (8 * plan.block_rows)).cast("int").alias("salts"))
    sizes = checkpointed(sizes.join(routers.select("node"), "node", "left_semi"))
    salted = each.join(sizes, "node").withColumn("salt", F.pmod(F.xxhash64("id", F.lit(plan.seed + 3)), F.col("salts")).cast("int")).drop("salts")
    copies = routers.join(sizes, "node").select("node", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "weights", "bias")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _unit(_matrix(left.column("vector").combine_chunks(), plan.dim))
        score = -left.column("loss").combine_chunks().to_numpy().astype(np.float32).reshape(-1, 1)
        node = left.column("node").combine_chunks().to_numpy().reshape(-1, 1)
        router = {int(node[0, 0]): _router_of(right.slice(0, 1).to_pylist()[0], plan)} if len(node) and right.num_rows else {}
        score, node = expand(x, score, node, router, plan)
        return pa.table({"id": left.column("id"), "found": _states(score, node)})

    down = salted.groupBy("node", "salt").cogroup(copies.groupBy("node", "salt")).applyInArrow(run, f"id long, found {_STATE}")
    stay = each.join(sizes.select("node"), "node", "left_anti").select("id", F.array(F.struct("loss", "node")).cast(_STATE).alias("found"))
    state = down.unionByName(stay).groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, plan.probes).alias("state"))
    return routed.drop("state").join(state, "id").select("id", "vector", *kept, "state")


def _route_all(rows: DataFrame, n: int, plan: KnnPlan) -> tuple[DataFrame, int]:
    """(``rows`` (id, vector, indexed) with their state at the leaves, best first; number of leaves)."""
    levels = _levels(n, plan)
    sample = bounded_sample(rows.filter("indexed").select("id", "vector"), "id", plan.sample_rows, n, plan.seed).select("vector").toArrow().column(0).combine_chunks()
    x = _unit(_matrix(sample, plan.dim)) if len(sample) else np.zeros((0, plan.dim), np.float32)
    parts = max(1, min(plan.fan_out, -(-n // levels[0]), len(x) // 16))
    routers: dict[int, Router] = {0: fit_partitions(x, parts, plan)}
    leaves = routers[0][1].size
    for level, rows_each in enumerate(levels[1:], 1):
        below = checkpointed(_fit_level(_descend(rows.filter("indexed"), routers, level, plan, []), rows_each, plan))
        more = below.agg(F.sum(F.size("bias") - 1)).first()[0] or 0
        if leaves + more > plan.most_leaves:  # from here on level by level, without a broadcast
            routed = checkpointed(_descend(rows, routers, level, plan, ["indexed"]))
            for i, each in enumerate(levels[level:]):
                below = below if not i else checkpointed(_fit_level(routed.filter("indexed"), each, plan))
                leaves += below.agg(F.sum(F.size("bias") - 1)).first()[0] or 0
                routed = checkpointed(_descend_joined(routed, below, plan, ["indexed"]))
            return routed, leaves
        routers |= {r["node"]: _router_of(r, plan) for r in below.collect()}
        leaves += more
    return checkpointed(_descend(rows, routers, len(levels), plan, ["indexed"])), leaves


# --- search -----------------------------------------------------------------------------------------------------------------


def _search(plan: KnnPlan):
    """Within one (partition, index block, query block): the k best of each query."""

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("id").combine_chunks().to_numpy()
        x = _matrix(group.column("vector").combine_chunks(), plan.dim).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        is_query = group.column("is_query").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(ids[~is_query], kind="stable")
        index_ids, index = ids[~is_query][order], x[~is_query][order]
        query_ids, query = ids[is_query], x[is_query]
        got_q, got_n, got_s = [], [], []
        k = min(plan.k + 1, len(index_ids))
        for at in range(0, len(query_ids) if k else 0, 512):
            q = query_ids[at : at + 512]
            s = query[at : at + 512] @ index.T
            rough = -np.partition(-s, k - 1, axis=1)[:, k - 1] - 2 * 10.0**-plan.digits
            rows, cols = np.nonzero(s >= rough[:, None])  # all that can be among the best after rounding, ties included
            sims = np.round(s[rows, cols], plan.digits)
            own = q[rows] == index_ids[cols]
            rows, cols, sims = rows[~own], cols[~own], sims[~own]
            by = np.lexsort((index_ids[cols], -sims, rows))
            rows, cols, sims = rows[by], cols[by], sims[by]
            first = np.searchsorted(rows, rows)
            best = np.arange(len(rows)) - first < plan.k
            got_q.append(q[rows[best]])
            got_n.append(index_ids[cols[best]])
            got_s.append(sims[best])
        if not got_q:
            none = pa.list_(pa.struct([("loss", pa.float64()), ("id", pa.int64())]))
            return pa.table({"id": pa.array([], pa.int64()), "found": pa.array([], none)})
        q, n, s = np.concatenate(got_q), np.concatenate(got_n), np.concatenate(got_s)
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        both = pa.StructArray.from_arrays([pa.array(-s), pa.array(n)], names=["loss", "id"])
        found = pa.ListArray.from_arrays(pa.array(np.append(starts, len(q)).astype(np.int32)), both)
        return pa.table({"id": pa.array(q[starts]), "found": found})

    return run


def _index_flag(rows: DataFrame, plan: KnnPlan) -> tuple[DataFrame, int]:
    """(``rows`` (id, vector) with ``indexed``, their number): false for the copies of a vector beyond its k + 1 smallest ids.

    Vectors are told apart by two hashes, so that only these are shuffled, and at most k + 2 rows of a vector from each task.
    """
    same = [F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(plan.seed)).alias("h2")]
    hashed = checkpointed(rows.select("id", *same))
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    crowded = checkpointed(hashed.withColumn("copy", rank).filter(F.col("copy") <= plan.k + 2).filter(F.col("copy") == plan.k + 2).select("h1", "h2", F.col("id").alias("cut")))
    marked = rows.select("id", "vector", *same).join(_small(crowded, plan), ["h1", "h2"], "left")
    return marked.select("id", "vector", F.coalesce(F.col("id") < F.col("cut"), F.lit(True)).alias("indexed")), hashed.count()


def _small(df: DataFrame, plan: KnnPlan) -> DataFrame:
    """``df``, to be broadcast if it has at most ``most_leaves`` rows."""
    return F.broadcast(df) if df.limit(plan.most_leaves + 1).count() <= plan.most_leaves else df


def nearest(vectors: DataFrame, plan: KnnPlan | None = None) -> DataFrame:
    """(id, neighbours: array of (loss, id)) for every usable row of ``vectors`` (id long, vector array<float>).

    ``loss`` is the negative cosine, rounded; neighbours are sorted by it and by id. Null vectors, wrong lengths, values that
    are null or not finite, and zero vectors are not usable; they give no row and are nobody's neighbour. Copies are rows of
    their own; an empty table gives an empty result.
    """
    plan = plan or KnnPlan()
    spark = vectors.sparkSession
    rows, n = _index_flag(vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<float>").alias("vector")).filter(usable("vector", plan.dim)), plan)
    routed, _ = _route_all(rows, n, plan)
    routed = routed.withColumn("routes", F.transform("state", lambda s: s["node"]))
    index = routed.filter("indexed").select("id", "vector", F.col("routes")[0].alias("part"))

    # The size of each partition, one row each.
    query_rows = routed.select(F.explode("routes").alias("part")).groupBy("part").agg(F.count("*").alias("queries"))
    count = lambda c, rows: F.ceil(F.coalesce(F.col(c), F.lit(0)) / rows).cast("int")
    blocks = index.groupBy("part").agg(F.count("*").alias("rows")).join(query_rows, "part").select("part", count("rows", plan.block_rows).alias("index_blocks"), count("queries", 4 * plan.block_rows).alias("query_blocks"))
    blocks = _small(checkpointed(blocks), plan)

    def block_of(count: str):
        return F.pmod(F.xxhash64("id", F.lit(plan.seed + 1)), F.col(count)).cast("int")

    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    as_index = index.join(blocks, "part").select("part", block_of("index_blocks").alias("i"), every("query_blocks").alias("q"), "id", "vector", F.lit(False).alias("is_query"))
    as_query = (
        routed.select("id", "vector", F.explode("routes").alias("part"))
        .join(blocks, "part")
        .select("part", every("index_blocks").alias("i"), block_of("query_blocks").alias("q"), "id", "vector", F.lit(True).alias("is_query"))
    )
    mb = n * (plan.probes + 1) * (4 * plan.dim + 16) / 1e6
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(mb / plan.task_mb))  # tasks of one size whatever the table
    found = as_index.unionByName(as_query).repartition(tasks, "part", "i", "q").groupBy("part", "i", "q").applyInArrow(_search(plan), "id long, found array<struct<loss: double, id: long>>")
    return found.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, plan.k).alias("neighbours"))


def neighbour_pairs(vectors: DataFrame, plan: KnnPlan | None = None) -> DataFrame:
    """Distinct (a, b), a < b: one is among the k most similar of the other."""
    found = nearest(vectors, plan).select("id", F.explode("neighbours.id").alias("other"))
    return found.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def brute_force(ids: np.ndarray, x: np.ndarray, k: int, digits: int = 9) -> pd.DataFrame:
    """The exact answer on a small fixture, for tests: (id, other)."""
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    out = []
    for i, row in enumerate(np.round(y @ y.T, digits)):
        order = [j for j in np.lexsort((ids, -row)) if j != i][:k]
        out += [(ids[i], ids[j]) for j in order]
    return pd.DataFrame(out, columns=["id", "other"])
