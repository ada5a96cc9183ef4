"""Nearest neighbours over learned partitions (operator 6).

A bounded sample of the vectors gives a graph of nearest neighbours, which is
cut into equal parts with few edges between them. A small classifier learns in
which parts a vector's neighbours lie. Every vector is indexed under its most
probable part; a query visits its most probable parts, as many as vectors that
were left out of the learning need for ``TARGET`` of their neighbours (and one
more), and the vectors found there are ranked by their exact inner product in
double precision. There are two parts at least, so the method is the same at
every size but the smallest tables of some vectors.

Equal vectors are one candidate that carries their least ids (one more than
asked for: no other id can be among the nearest), so a vector that a third of
the rows share takes no more room than any other. Parts are split into blocks
of about ``BLOCK`` candidates, and a part's queries into blocks of about
``QUERY_BLOCK``; each pair of blocks meets in one task, and what a query finds
comes together as one short list a block.

Defined results: vectors that are null, empty, zero, of another length than
most, or hold null or non-finite components, and rows with a null id, take no
part; rows that repeat an id and a vector count once, and a query is never its
own neighbour; a query with fewer candidates gets all; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wapspark.session import ensure_checkpoint_dir

SAMPLE = 8192      # vectors that the partitions are learned from
HELD_OUT = 512     # of them (a quarter at most) that only set how many parts a query visits
TARGET = 0.95
PART = 1000        # vectors a part, until there are MAX_PARTS
MAX_PARTS = 256
BLOCK = 1 << 14
QUERY_BLOCK = 1 << 14
GRAPH = 10         # neighbours of a vector in the graph
HIDDEN = 128
EPOCHS = 40


def nearest(queries: np.ndarray, vectors: np.ndarray, k: int, own: np.ndarray | None = None):
    """Places of the k largest inner products of each query, block by block;
    ``own`` are places that don't count for their query."""
    k = min(k, len(vectors) - (own is not None))
    out = np.zeros((len(queries), max(k, 0)), np.int64)
    for lo in range(0, len(queries), 512):
        dots = queries[lo:lo + 512] @ vectors.T
        if own is not None:
            dots[np.arange(len(dots)), own[lo:lo + 512]] = -np.inf
        if k > 0:
            out[lo:lo + 512] = np.argpartition(-dots, k - 1, axis=1)[:, :k]
    return out


def cut_graph(vectors: np.ndarray, graph: np.ndarray, parts: int, rng) -> np.ndarray:
    """Equal parts of a graph with few edges between: vectors dealt to the
    nearest of ``parts`` seeds with room, then moved to the part of most of
    their neighbours while the parts stay equal."""
    n = len(vectors)
    room = int(np.ceil(1.1 * n / parts))
    sums = vectors[rng.choice(n, parts, replace=False)].copy()
    part = np.zeros(n, np.int64)
    for _ in range(8):
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        near = vectors @ centre.T
        wish = np.argsort(-near, axis=1)
        size = np.zeros(parts, np.int64)
        for i in np.argsort(-near.max(axis=1)).tolist():
            for p in wish[i]:
                if size[p] < room:
                    part[i] = p
                    size[p] += 1
                    break
        sums = np.zeros_like(sums)
        np.add.at(sums, part, vectors)
    edges = np.concatenate((np.stack((np.repeat(np.arange(n), graph.shape[1]), graph.ravel()), 1),
                            np.stack((graph.ravel(), np.repeat(np.arange(n), graph.shape[1])), 1)))
    size = np.bincount(part, minlength=parts)
    for _ in range(10):
        count = np.zeros((n, parts), np.int32)
        np.add.at(count, (edges[:, 0], part[edges[:, 1]]), 1)
        best = count.argmax(axis=1)
        gain = count[np.arange(n), best] - count[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain).tolist():
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A one-layer network from a vector to its neighbours' likely parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        size = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
        return np.maximum(vectors / size @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def dump(self) -> dict:
        return {"visits": self.visits, **{k: getattr(self, k).tobytes() for k in ("w1", "b1", "w2", "b2")}}

    @staticmethod
    def load(row, dim: int) -> "Router":
        get = [np.frombuffer(bytes(row[k])) for k in ("w1", "b1", "w2", "b2")]
        return Router(get[0].reshape(dim, -1), get[1], get[2].reshape(len(get[1]), -1), get[3],
                      row["visits"])


def learn(vectors: np.ndarray, parts: int, k: int) -> Router:
    """Learns parts of a sample, and how many of them a query must visit."""
    rng = np.random.default_rng(7)
    order = rng.permutation(len(vectors))
    held = min(HELD_OUT, len(vectors) // 4)
    asked, vectors = vectors[order[:held]], vectors[np.sort(order[held:])]
    n, dim = vectors.shape
    graph = nearest(vectors, vectors, GRAPH, np.arange(n))
    part = cut_graph(vectors, graph, parts, rng)
    goal = np.zeros((n, parts))
    np.add.at(goal, (np.repeat(np.arange(n), graph.shape[1]), part[graph.ravel()]), 1.0)
    goal[np.arange(n), part] += 1.0
    goal /= goal.sum(axis=1, keepdims=True)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    weights = [rng.normal(0, (2 / dim) ** .5, (dim, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, (2 / HIDDEN) ** .5, (HIDDEN, parts)), np.zeros(parts)]
    m1, m2 = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for lo in range(0, n, 256):
            x, y = unit[order[lo:lo + 256]], goal[order[lo:lo + 256]]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            out = hidden @ weights[2] + weights[3]
            p = np.exp(out - out.max(axis=1, keepdims=True))
            slope = (p / p.sum(axis=1, keepdims=True) - y) / len(x)
            back = (slope @ weights[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((x.T @ back, back.sum(0), hidden.T @ slope, slope.sum(0))):
                m1[i] = 0.9 * m1[i] + 0.1 * g
                m2[i] = 0.999 * m2[i] + 0.001 * g * g
                weights[i] -= 2e-3 * (m1[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(m2[i] / (1 - 0.999 ** step)) + 1e-8)
    router = Router(*weights, visits=parts)
    if not held:
        return router  # visits all
    truth = nearest(asked, vectors, k)
    ranks = np.argsort(np.argsort(-router.scores(asked), axis=1), axis=1)
    place = router.scores(vectors).argmax(axis=1)
    needed = np.sort(np.take_along_axis(ranks, place[truth], axis=1).ravel())
    if len(needed):
        router.visits = int(needed[min(int(TARGET * len(needed)), len(needed) - 1)]) + 1
    return router


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _fit(parts: int, dim: int, k: int):
    def run(batches):
        table = pa.Table.from_batches(list(batches)).sort_by("id")
        row = learn(_matrix(table.column("vec"), dim), parts, k).dump()
        yield pa.RecordBatch.from_pylist([row])
    return run


def _score(dim: int, k: int):
    """The nearest of a block's candidates to each query that visits it."""
    def run(key, queries, candidates):
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()),
                             "found": pa.array([], pa.list_(pa.int64())),
                             "scores": pa.array([], pa.list_(pa.float64()))})
        candidates = candidates.sort_by("id")
        vectors, first = _matrix(candidates.column("vec"), dim), candidates.column("id").to_numpy()
        ids = candidates.column("ids").to_pylist()
        names = queries.column("query_id").to_numpy()
        asked = _matrix(queries.column("vec"), dim)
        found, scores = [], []
        for lo in range(0, len(asked), 256):
            dots = asked[lo:lo + 256] @ vectors.T
            for q, line in zip(names[lo:lo + 256].tolist(), dots):
                own = np.arange(len(line))
                if len(line) > k + 1:  # all that reach the (k+1)-th best score
                    own = np.flatnonzero(line >= np.partition(line, -k - 1)[-k - 1])
                own = own[np.lexsort((first[own], -line[own]))][:k + 1]
                pairs = [(-line[c], i) for c in own.tolist() for i in ids[c] if i != q]
                pairs = sorted(pairs)[:k]
                found.append([i for _, i in pairs])
                scores.append([-s for s, _ in pairs])
        return pa.table({"query_id": pa.array(names), "found": pa.array(found, pa.list_(pa.int64())),
                         "scores": pa.array(scores, pa.list_(pa.float64()))})
    return run


def _merge(k: int):
    """The k best of what a query's blocks have found; an id with two vectors
    counts by its better one."""
    def run(key, table):
        best: dict[int, float] = {}
        for ids, scores in zip(table.column("found").to_pylist(), table.column("scores").to_pylist()):
            for i, s in zip(ids, scores):
                best[i] = max(s, best.get(i, -np.inf))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        return pa.table({
            "query_id": pa.array([key[0].as_py()] * len(top), pa.int64()),
            "rank": pa.array(range(1, len(top) + 1), pa.int32()),
            "vec_id": pa.array([i for i, _ in top], pa.int64()),
            "score": pa.array([s for _, s in top], pa.float64())})
    return run


def search(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of every row for which ``is_query`` (a condition
    on ``id``) holds: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``;
    ties go to the smaller id."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    # -0.0 and 0.0 are one value, so that equal vectors group.
    vec = F.transform(vec, lambda x: x + F.lit(0.0))
    good = rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("id").isNotNull() & F.forall("vec", lambda x: F.coalesce(
            (F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
        & F.exists("vec", lambda x: x != 0))
    sizes = good.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim = sizes["dim"]
    good = good.filter(F.size("vec") == dim).distinct()
    least = Window.partitionBy("vec").orderBy("id")
    candidates = (good.withColumn("nth", F.row_number().over(least)).filter(f"nth <= {k + 1}")
                  .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                  .select(F.element_at("ids", 1).alias("id"), "ids", "vec").checkpoint())
    n = candidates.count()
    parts = int(min(MAX_PARTS, max(2 if n >= 4 * GRAPH else 1, n // PART)))
    queries = good.filter(is_query).select(F.col("id").alias("query_id"), "vec")
    if parts > 1:
        sample = candidates.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        got = sample.coalesce(1).mapInArrow(
            _fit(parts, dim, k), "visits long, w1 binary, b1 binary, w2 binary, b2 binary").collect()
        router = Router.load(got[0], dim)
    else:
        router = Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)

    def route(visits):
        def run(batches):
            for batch in batches:
                vectors = _matrix(batch.column("vec"), dim)
                top = np.argsort(-router.scores(vectors), axis=1, kind="stable")[:, :visits]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(top.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    names=[*batch.schema.names, "parts"])
        return run

    held = candidates.mapInArrow(route(1), "id long, ids array<long>, vec array<double>, "
                                           "parts array<int>").withColumn("part", F.get("parts", 0))
    held = held.drop("parts").checkpoint()
    cut = held.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cut"))  # a row a part
    held = held.join(F.broadcast(cut), "part").withColumn(
        "block", F.pmod(F.xxhash64("id"), "cut").cast("int")).drop("cut")
    asked = queries.mapInArrow(route(min(router.visits + 1, parts)),
                               "query_id long, vec array<double>, parts array<int>").checkpoint()
    query_cut = asked.select(F.explode("parts").alias("part")).groupBy("part").agg(
        F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_cut"))  # a row a part
    asked = asked.select("query_id", "vec", F.explode("parts").alias("part")).join(
        F.broadcast(query_cut), "part").withColumn(
        "query_block", F.pmod(F.xxhash64("query_id"), "query_cut").cast("int"))
    asked = asked.join(F.broadcast(cut), "part").select(
        "query_id", "vec", "part", "query_block",
        F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("block"))
    held = held.join(F.broadcast(query_cut), "part").select(
        "id", "ids", "vec", "part", "block",
        F.explode(F.sequence(F.lit(0), F.col("query_cut") - 1)).alias("query_block"))
    pair = ["part", "block", "query_block"]
    found = asked.groupBy(*pair).cogroup(held.groupBy(*pair)).applyInArrow(
        _score(dim, k), "query_id long, found array<long>, scores array<double>")
    return found.groupBy("query_id").applyInArrow(_merge(k), schema)
