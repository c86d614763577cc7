"""The k most similar vectors of every vector.

Balanced posting lists. A bounded sample is split again and again by k-means until each leaf is small; the leaves'
means are the centroids, so a dense region gets as many lists as its share of the rows and lists stay balanced. The
centroids and a graph of their neighbours are broadcast (bounded, see below); each vector finds its nearest centroids by
a beam search in that graph. A vector near the border of several lists is replicated to each whose distance is within a ratio
of the nearest one, and a query visits the lists within another ratio. Within a list, neighbours are found by blocked
matrix products; the lists' answers are merged per vector.

Sizes. Every row is indexed; only the fit uses a sample, of at most ``PER_LEAF * MAX_LISTS`` vectors (131,072: 32 MB).
At most ``MAX_LISTS`` centroids (4 MB) and their graph (1 MB) are broadcast. Beyond ``MAX_LISTS * LIST_SIZE`` vectors lists
grow; a list that indexes over ``BLOCK`` rows, by count, is cut into blocks that each query of the list visits, so that a task indexes
about a block, wherever the sample missed a dense region. Equal vectors are collapsed first: of each, the k + 1 smallest ids are its representatives (a group
limit applied before the shuffle), since a vector with more copies has only copies as neighbours.

Defined cases: vectors that are null, of another size, all zeros, or hold a null, NaN or infinite value take no part; rows
sent twice count once; ties go to the smaller id; fewer than k + 1 vectors give fewer neighbours; an empty table gives
no rows; extra columns are ignored.

Accuracy. ``REPLICAS`` and ``PROBES`` bound the lists of a vector, and so what may be missed; ``exact=True`` takes a single list, cut into blocks that
every vector visits, which misses nothing but what single precision can't tell apart, and costs the square of the collection.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.runtime import materialize

K, DIM = 5, 64
LIST_SIZE, MAX_LISTS, PER_LEAF, BLOCK = 256, 16384, 8, 16384
DEGREE, BEAM = 16, 16
REPLICAS, PROBES = 3, 4
INDEX_RATIO, PROBE_RATIO = 1.12, 1.25


def usable(chunks: DataFrame, dim: int = DIM) -> DataFrame:
    """``chunk_id, embedding, h``: vectors of ``dim`` finite values that are not all zero."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("float")))
    return chunks.where(F.col("chunk_id").isNotNull() & (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0)).select("chunk_id", v.alias("embedding"), F.xxhash64(v).alias("h"))


def nodes(vectors: DataFrame, k: int = K) -> DataFrame:
    """One row for each different vector: ``h, ids`` (its k + 1 smallest ids) ``, embedding``."""
    ranked = vectors.withColumn("r", F.dense_rank().over(Window.partitionBy("h").orderBy("chunk_id"))).where(F.col("r") <= k + 1)
    return ranked.groupBy("h").agg(F.array_sort(F.collect_set("chunk_id")).alias("ids"), F.first("embedding").alias("embedding"))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def _kmeans(x: np.ndarray, c: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Cluster of each row."""
    means = x[rng.choice(len(x), c, replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ means.T - 0.5 * (means * means).sum(axis=1), axis=1)
        sums = np.zeros((c, x.shape[1]), np.float32)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=c)
        means = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], means)
    return own


def fit(sample: np.ndarray, lists: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of balanced lists and the share of the sample in each; leaves hold about the same number of vectors."""
    rng, leaf = np.random.default_rng(seed), max(1, -(-len(sample) // max(1, lists)))
    todo, leaves = [np.arange(len(sample))], []
    while todo:
        own = todo.pop()
        if len(own) <= leaf * 1.5 or len(own) < 2:
            leaves.append(own)
            continue
        c = int(min(16, len(own), max(2, round(len(own) / leaf))))
        at = _kmeans(sample[own], c, rng)
        parts = [own[at == j] for j in range(c)]
        if max(map(len, parts)) == len(own):  # nothing to tell them apart
            parts = np.array_split(own, c)
        todo.extend(p for p in parts if len(p))
    means = unit(np.stack([sample[p].mean(axis=0) + 1e-12 for p in leaves]))
    return means, np.array([len(p) for p in leaves]) / len(sample)


class Graph:
    """Centroids with their neighbours among each other, and the beam search over them."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.c, n = centroids, len(centroids)
        d = min(degree, n - 1)
        self.near = np.zeros((n, d), np.int32)
        for at in range(0, n if d else 0, 1024):
            s = centroids[at : at + 1024] @ centroids.T
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
            self.near[at : at + 1024] = np.argpartition(-s, d - 1, axis=1)[:, :d]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, max(64, int(4 * n**0.5)))).astype(np.int32))

    def search(self, q: np.ndarray, beam: int = BEAM, rounds: int = 10, wide: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the nearest centroids found, best first."""
        s = q @ self.c[self.entries].T
        beam = min(beam, s.shape[1])
        top = np.argpartition(-s, beam - 1, axis=1)[:, :beam]
        ids, sims = self.entries[top], np.take_along_axis(s, top, 1)
        done = np.zeros(ids.shape, bool)
        if self.near.shape[1]:
            active = np.arange(len(q))
            for _ in range(rounds):
                i, v, f = ids[active], sims[active], done[active]
                pick = np.argsort(np.where(f, np.inf, -v), axis=1)[:, :wide]
                np.put_along_axis(f, pick, True, 1)
                new = self.near[np.take_along_axis(i, pick, 1)].reshape(len(i), -1)
                score = np.einsum("bd,bmd->bm", q[active], self.c[new])
                i, v, f = np.concatenate([i, new], 1), np.concatenate([v, score], 1), np.concatenate([f, np.zeros(new.shape, bool)], 1)
                order = np.argsort(i, axis=1, kind="stable")  # a known node precedes its repetition
                i, v, f = (np.take_along_axis(a, order, 1) for a in (i, v, f))
                v[:, 1:][i[:, 1:] == i[:, :-1]] = -np.inf
                best = np.argpartition(-v, beam - 1, axis=1)[:, :beam]
                ids[active], sims[active], done[active] = (np.take_along_axis(a, best, 1) for a in (i, v, f))
                half = np.partition(-sims[active], beam // 2, axis=1)[:, beam // 2, None]
                active = active[((-sims[active] <= half) & ~done[active]).any(axis=1)]
                if not len(active):
                    break
        order = np.argsort(-sims, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _stack(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assign(shared, dim: int):
    """Adds ``lists``: those of the vector, nearest first, and how many of them index it and are probed for it."""

    def run(batches):
        graph: Graph = shared.value
        for b in batches:
            lists, n_index, n_probe = [], [], []
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                ids, sims = graph.search(unit(_stack(part.column("embedding"), dim)))
                dist = np.sqrt(np.maximum(2 - 2 * sims, 1e-9))
                ratio = dist / dist[:, :1]
                index = np.minimum((ratio <= INDEX_RATIO).sum(axis=1), REPLICAS)
                probe = np.minimum((ratio <= PROBE_RATIO).sum(axis=1), PROBES)
                lists += [row[: max(i, p)] for row, i, p in zip(ids, index, probe)]
                n_index.append(index)
                n_probe.append(probe)
            many = lambda a: pa.array(np.concatenate(a) if a else np.zeros(0), pa.int32())
            yield pa.record_batch([*b.columns, pa.array(lists, pa.list_(pa.int32())), many(n_index), many(n_probe)], names=[*b.schema.names, "lists", "n_index", "n_probe"])

    return run


def _join(k: int, dim: int):
    """Within one block of a list: the k nearest indexed vectors of each probing one."""
    kind = pa.list_(pa.struct([("sim", pa.float64()), ("id", pa.int64())]))

    def run(t: pa.Table) -> pa.Table:
        h, ids = t.column("h").to_numpy(), t.column("ids").to_pylist()
        x = unit(_stack(t.column("embedding"), dim))
        index, probe = np.flatnonzero(t.column("indexed").to_numpy()), np.flatnonzero(t.column("probes").to_numpy())
        c, out = x[index], []
        for at in range(0, len(probe), 512):
            rows = probe[at : at + 512]
            s = x[rows] @ c.T
            s[h[rows][:, None] == h[index][None, :]] = -2
            m = min(k, s.shape[1])
            top = np.argpartition(-s, m - 1, axis=1)[:, :m] if m else np.zeros((len(rows), 0), int)
            near = index[top]
            # the same two vectors give the same number in every list
            sims = (x[rows][:, None, :].astype(np.float64) * x[near]).sum(axis=2)
            low = np.take_along_axis(s, top, 1) <= -2
            for r in range(len(rows)):
                out.append([{"sim": float(sims[r, j]), "id": i} for j in range(m) if not low[r, j] for i in ids[near[r, j]][:k]])
        return pa.table({"h": pa.array(h[probe]), "ids": pa.array([ids[r] for r in probe], pa.list_(pa.int64())), "near": pa.array(out, kind)})

    return run


def neighbours(rows: DataFrame, k: int = K, dim: int = DIM, exact: bool = False) -> DataFrame:
    """``h, ids, near``: for each node its ids and, best first, up to k ``(sim, id)`` of other vectors."""
    spark = rows.sparkSession
    n = rows.count()
    lists = 1 if exact else int(min(MAX_LISTS, max(1, -(-n // LIST_SIZE))))
    want = min(n, PER_LEAF * lists)
    part = rows.where(F.pmod(F.xxhash64("h"), F.lit(max(n, 1))) < want).select("embedding").limit(PER_LEAF * MAX_LISTS).toArrow()
    if not part.num_rows:
        part = rows.select("embedding").limit(1000).toArrow()
    means = fit(unit(_stack(part.column("embedding"), dim)), lists)[0] if part.num_rows and not exact else np.ones((1, dim), np.float32)
    shared = spark.sparkContext.broadcast(Graph(means))
    assigned = materialize(rows.mapInArrow(_assign(shared, dim), "h bigint, ids array<bigint>, embedding array<float>, lists array<int>, n_index int, n_probe int"), "p2-assigned")
    # rows that each list indexes; almost always one block. At most as many rows as there are lists
    sizes = assigned.select(F.explode(F.slice("lists", F.lit(1), F.col("n_index"))).alias("list")).groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    large = sizes.select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks"))
    spread = (
        assigned.select("h", "ids", "embedding", "n_index", "n_probe", F.posexplode("lists").alias("pos", "list"))
        .join(F.broadcast(large), "list", "left")
        .select("h", "ids", "embedding", "list", (F.col("pos") < F.col("n_index")).alias("indexed"), (F.col("pos") < F.col("n_probe")).alias("probes"), F.coalesce("n_blocks", F.lit(1)).alias("n_blocks"))
    )
    own = F.pmod("h", "n_blocks").cast("int")
    # a query goes to each block of its list, an indexed row to its own
    spread = spread.withColumn("block", F.explode(F.when(F.col("probes"), F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(F.array(own)))).withColumn("indexed", F.col("indexed") & (F.col("block") == own))
    found = spread.select("list", "block", "h", "ids", "embedding", "indexed", "probes").groupBy("list", "block").applyInArrow(_join(k, dim), "h bigint, ids array<bigint>, near array<struct<sim:double,id:bigint>>")
    best = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))), lambda a, b: F.when(a["sim"] > b["sim"], -1).when(a["sim"] < b["sim"], 1).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0))
    return found.groupBy("h").agg(F.first("ids").alias("ids"), F.slice(best, 1, k).alias("near"))


def nearest(chunks: DataFrame, k: int = K, dim: int = DIM, exact: bool = False) -> DataFrame:
    """``chunk_id, rank, other_id``: the k most similar pieces of every piece."""
    rows = materialize(nodes(usable(chunks, dim), k), "p2-nodes")
    near = neighbours(rows, k, dim, exact)
    own = near.select(F.explode("ids").alias("chunk_id"), F.slice(F.concat(F.array_remove("ids", F.col("chunk_id")), F.transform("near", lambda x: x["id"])), 1, k).alias("others"))
    # copies beyond the k + 1 representatives: their neighbours are the first k of those
    full = materialize(rows.where(F.size("ids") > k).select("h", "ids"), "p2-copies")
    salts = 16
    spread = full.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rest = (
        usable(chunks, dim)
        .select("h", "chunk_id", F.pmod("chunk_id", F.lit(salts)).cast("int").alias("salt"))
        .join(spread, ["h", "salt"])
        .where(~F.array_contains("ids", F.col("chunk_id")))
        .select("chunk_id", F.slice("ids", 1, k).alias("others"))
    )
    both = own.unionByName(rest) if not full.isEmpty() else own
    return both.select("chunk_id", F.posexplode("others").alias("rank", "other_id")).withColumn("rank", F.col("rank") + 1)


def pairs(chunks: DataFrame, k: int = K, dim: int = DIM) -> DataFrame:
    """``chunk_id_a, chunk_id_b``, a < b: one is among the k nearest of the other."""
    n = nearest(chunks, k, dim)
    return n.select(F.least("chunk_id", "other_id").alias("chunk_id_a"), F.greatest("chunk_id", "other_id").alias("chunk_id_b")).distinct()
