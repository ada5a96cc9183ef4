"""Embedding near-duplicates by PCA-ordered tiled comparison (operator 13).

Vectors of one label and one length link when their cosine is ``least`` or
more; classes are the components of the links.

1. Equal vectors of a label become one node with a number of copies. The
   second moments of the unit vectors of the most frequent length, added up
   over all of them, give their principal axes, strongest first; other lengths
   keep their own axes. Axes only steer the work: any rotation gives the same
   links.
2. A label's nodes are ordered along the first axis (``rank_positions``: range
   partitions, so a label that holds a third of all rows spans many) and cut
   into tiles of bounded bytes. Unit vectors of a cosine of ``least`` lie within
   r = sqrt(2 - 2 least) of one another, so only tiles whose spans on the first
   axis come within r meet.
3. Two tiles are compared block by block in the order of the axes: inner
   products over the leading axes are accumulated first, and what the others
   can still add is bounded by the product of the suffix norms. A pair whose
   sum and bound stay under the threshold is dropped, a block whose pairs are
   all dropped ends. Pairs within ``CLOSE`` of the threshold are measured again
   on the original vectors, in double precision.
4. A tile pair returns, for each node with a link, the number of its links and
   a node that stands for all in reach: no pair is ever written. Counts are
   summed, components follow from the edges.

Memory: two tiles of ``TILE_BYTES`` and one block of products; shuffled are
the tiles, once for each tile they meet. Evenly spread vectors meet most of
their label, and a large group of near copies meets itself; that work grows
with the square of a label then, as the exact number of links does.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label, link with nothing, not even with their
copies; repeated rows are rows of their own and link as equal vectors do
(``n_links`` counts rows); a null id takes part and never names a component
unless its component has no other; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.llm import words as W
from wapspark.llm.components import connected_components
from wapspark.operators.ranking import rank_positions
from wapspark.session import ensure_checkpoint_dir

# Vectors of one tile (doubles), rows of one block of products, partial sums
# that meet at once, and the leading share of axes added at each step.
TILE_BYTES = 1 << 20
BLOCK = 512
FAN_IN = 8
STEPS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)
# Rounding of a product of unit vectors stays far below this.
CLOSE = 1e-9
# Pairs are followed one by one once so small a share of a block is left.
FEW = 0.1


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, which rounds nothing and keeps squares
    in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _moments(dim: int):
    """Sums of products of the components, one matrix a task."""
    @W.give_back
    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            x = _unit(_matrix(batch.column("vec"), dim))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    return run


def _add_moments(dim: int):
    def run(key, table):
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("sums"))
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})
    return run


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Axes (columns) of the vectors' second moments, strongest first. Every
    task sends one matrix; ``FAN_IN`` at a time are added until one is left."""
    sums = vectors.mapInArrow(_moments(dim), "sums binary").checkpoint()
    while (n := sums.count()) > 1:
        sums = (sums.withColumn("part", F.spark_partition_id() % math.ceil(n / FAN_IN))
                .groupBy("part").applyInArrow(_add_moments(dim), "sums binary").checkpoint())
    total = np.frombuffer(sums.first().sums, np.float64).reshape(dim, dim)
    values, axes = np.linalg.eigh(total)
    return np.ascontiguousarray(axes[:, np.argsort(-values)])


def _lead(dim: int, axis: np.ndarray):
    """Appends each vector's coordinate on the first axis."""
    @W.give_back
    def run(batches):
        for batch in batches:
            lead = _unit(_matrix(batch.column("vec"), dim)) @ axis
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lead)],
                                             names=[*batch.schema.names, "lead"])
    return run


def links(x: np.ndarray, y: np.ndarray, exact_x: np.ndarray, exact_y: np.ndarray,
          least: float) -> tuple[np.ndarray, int]:
    """Which rows of ``x`` and ``y`` (unit vectors on ordered axes) reach the
    cosine, and how many products of components that took."""
    dim = x.shape[1]
    cuts = sorted({max(1, min(dim, round(dim * s))) for s in STEPS})
    rest = [np.sqrt(np.maximum(0.0, np.cumsum((v * v)[:, ::-1], axis=1)[:, ::-1])) for v in (x, y)]
    total = np.zeros((len(x), len(y)))
    at, before, cost = None, 0, 0
    for cut in cuts:
        if at is None:
            total += x[:, before:cut] @ y[:, before:cut].T
            cost += total.size * (cut - before)
        else:
            kept += np.einsum("ij,ij->i", x[at[0], before:cut], y[at[1], before:cut])
            cost += len(kept) * (cut - before)
        before = cut
        if cut == dim:
            break
        a, b = rest[0][:, cut], rest[1][:, cut]
        if at is None:
            able = total + a[:, None] * b[None, :] >= least - CLOSE
            if np.count_nonzero(able) <= FEW * able.size:
                at = np.nonzero(able)
                kept = total[at]
        else:
            able = kept + a[at[0]] * b[at[1]] >= least - CLOSE
            at, kept = (at[0][able], at[1][able]), kept[able]
        if at is not None and not len(at[0]):
            return np.zeros(total.shape, bool), cost
    if at is None:
        found = total >= least
        near = np.nonzero(np.abs(total - least) <= CLOSE)
    else:
        found = np.zeros(total.shape, bool)
        found[at[0], at[1]] = kept >= least
        edge = np.abs(kept - least) <= CLOSE
        near = at[0][edge], at[1][edge]
    if len(near[0]):
        p, q = _scaled(exact_x[near[0]]), _scaled(exact_y[near[1]])
        found[near] = (p * q).sum(axis=1) / np.sqrt(
            (p * p).sum(axis=1) * (q * q).sum(axis=1)) >= least
    return found, cost


def _compare(dim: int, axes: np.ndarray, least: float):
    """Step 3: links of one tile with itself or another one."""
    def run(key, table):
        other = key[1].as_py() != key[2].as_py()
        side = table.column("side").to_numpy()
        order = np.lexsort((table.column("node").to_numpy(), side))
        side = side[order]
        node = table.column("node").to_numpy()[order]
        copies = table.column("copies").to_numpy()[order]
        exact = _matrix(table.column("vec"), dim)[order]
        n = len(node)
        x = _unit(exact) @ axes
        # Leading coordinate order: a block's pairs agree on it, or end early.
        split = int((side == 0).sum()) if other else n
        along = np.concatenate([np.argsort(x[:split, 0], kind="stable"),
                                split + np.argsort(x[split:, 0], kind="stable")])
        x, exact, node, copies = x[along], exact[along], node[along], copies[along]
        count, label = np.zeros(n, np.int64), np.arange(n)
        width = math.sqrt(2 - 2 * least) + CLOSE
        pairs = []
        for a in range(0, split, BLOCK):
            a_end = min(a + BLOCK, split)
            for b in range(split if other else a, n, BLOCK):
                b_end = min(b + BLOCK, n)
                if (x[b, 0] - x[a_end - 1, 0] > width) or (x[a, 0] - x[b_end - 1, 0] > width):
                    continue
                found, _ = links(x[a:a_end], x[b:b_end], exact[a:a_end], exact[b:b_end], least)
                if a == b and not other:
                    np.fill_diagonal(found, False)
                if not found.any():
                    continue
                count[a:a_end] += found @ copies[b:b_end]
                if a != b or other:
                    count[b:b_end] += found.T @ copies[a:a_end]
                # A spanning forest of the block: each row's first link, and each column's.
                rows, cols = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
                left, right = block_forest(found, rows, cols)
                pairs.append((a + left, b + right))
        if pairs:
            u, v = (np.concatenate(x) for x in zip(*pairs))
            label = _components(n, u, v)
        some = np.flatnonzero(count > 0)
        return pa.table({"node": node[some], "parent": node[label[some]], "links": count[some]})
    return run


def block_forest(found: np.ndarray, rows: np.ndarray, cols: np.ndarray):
    """Pairs of ``found`` that connect whatever all its pairs connect: at most
    one for each row and column, found by growing each component breadth first."""
    left, right = [], []
    seen_row, seen_col = np.zeros(found.shape[0], bool), np.zeros(found.shape[1], bool)
    for r in rows.tolist():
        if seen_row[r]:
            continue
        seen_row[r] = True
        front = np.array([r])
        while len(front):
            reach = found[front] & ~seen_col[None, :]
            new = np.flatnonzero(reach.any(axis=0))
            left.append(front[reach[:, new].argmax(axis=0)])
            right.append(new)
            seen_col[new] = True
            back = found[:, new] & ~seen_row[:, None]
            front = np.flatnonzero(back.any(axis=1))
            left.append(front)
            right.append(new[back[front].argmax(axis=1)] if len(front) else front)
            seen_row[front] = True
    return np.concatenate(left), np.concatenate(right)


def _components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Least index in reach of each of n, over the edges (u, v)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _tile_pairs(tiles: DataFrame, width: float) -> DataFrame:
    """Pairs (a, b) of tiles of one label, a <= b, whose spans on the first
    axis come within ``width``: tiles meet in the bins of that width which
    their spans, widened to the right, cover."""
    bins = tiles.select("label", "tile", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") + width) / width))).alias("bin"))
    return (bins.alias("x").join(bins.alias("y"), ["label", "bin"])
            .filter((F.col("x.tile") <= F.col("y.tile"))
                    & (F.col("y.lo") - F.col("x.hi") <= width)
                    & (F.col("x.lo") - F.col("y.hi") <= width))
            .select("label", F.col("x.tile").alias("a"), F.col("y.tile").alias("b")).distinct())


def _linked(nodes: DataFrame, dim: int, least: float, common: bool) -> DataFrame:
    """Node, parent and number of links, for the nodes of one length."""
    axes = principal_axes(nodes, dim) if common else np.eye(dim)
    width = math.sqrt(max(0.0, 2 - 2 * least)) + CLOSE
    tile_rows = max(BLOCK, TILE_BYTES // (8 * dim))
    placed = rank_positions(
        nodes.select("node", "label", "copies", "vec").mapInArrow(
            _lead(dim, axes[:, 0]), f"node long, label {nodes.schema['label'].dataType.simpleString()}, "
            "copies long, vec array<double>, lead double"),
        [F.col("lead"), F.col("node")], ["label"]).select(
        "node", "label", "copies", "vec", "lead",
        F.floor(F.col("_rk_before") / tile_rows).alias("tile")).checkpoint()
    tiles = placed.groupBy("label", "tile").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi"))
    pairs = _tile_pairs(tiles, width)
    sides = pairs.select("label", "a", "b", F.explode(F.when(
        F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))).alias("tile"))
    met = placed.drop("lead").join(sides, ["label", "tile"]).select(
        "label", "a", "b", (F.col("tile") != F.col("a")).cast("int").alias("side"),
        "node", "copies", "vec")
    return met.groupBy("label", "a", "b").applyInArrow(
        _compare(dim, axes, least), "node long, parent long, links long")


def group(rows: DataFrame, least: float = 0.98, id_col: str = "vec_id",
          vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: ``vec_id``, ``n_links`` (rows linked directly), ``component_id``
    (least id reachable) and ``kept`` (it names its component)."""
    ensure_checkpoint_dir(rows.sparkSession)
    # -0.0 and 0.0 are one value, so that equal vectors group.
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))
    read = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                       vec.alias("vec"))
    good = F.coalesce(F.col("label").isNotNull() & F.forall("vec", lambda x: F.coalesce(
        (F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
        & F.exists("vec", lambda x: x != 0), F.lit(False))
    # Two hashes name a vector: 128 bits within a label.
    read = read.withColumn("good", good).withColumns({
        "k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(13), "vec")})
    nodes = (read.filter("good").groupBy("label", "k1", "k2").agg(
        F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("own"))
        .withColumn("node", F.monotonically_increasing_id()).checkpoint())
    sizes = nodes.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").collect()
    found = None
    for i, r in enumerate(sizes):  # a length each
        some = _linked(nodes.filter(F.size("vec") == r["dim"]), r["dim"], least, i == 0)
        found = some if found is None else found.unionByName(some)
    plain = read.filter(~F.col("good")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return plain.withColumn("kept", F.lit(True))
    found = found.checkpoint()
    roots = connected_components(found.select("node", "parent"))
    links_of = found.groupBy("node").agg(F.sum("links").alias("links"))
    own = (nodes.select("label", "k1", "k2", "node", "own", "copies")
           .join(roots, "node", "left").join(links_of, "node", "left")
           .select("label", "k1", "k2", "root", "own", (F.coalesce("links", F.lit(0))
                                                        + F.col("copies") - 1).alias("n_links"))
           .checkpoint())
    first = own.filter("root is not null").groupBy("root").agg(F.min("own").alias("least"))
    named = own.join(first, "root", "left").select(
        "label", "k1", "k2", "n_links", F.coalesce("least", "own").alias("component_id"))
    linked = read.filter("good").select("vec_id", "label", "k1", "k2").join(
        named, ["label", "k1", "k2"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(plain).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def oracle_sql(table: str, least: float = 0.98) -> str:
    """DuckDB SQL for ``group``: every pair of a label, then all that is in reach."""
    return f"""
with recursive read as (
    select row_number() over () as nth, vec_id, label, embedding::double[] as v from {table}),
good as (
    select * from read where label is not null and len(v) > 0
        and len(list_filter(v, lambda x: x is not null and isfinite(x))) = len(v)
        and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (
    select a.nth as x, b.nth as y from good a join good b
    on a.label = b.label and a.nth <> b.nth and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= {least}),
walk(x, y) as (select x, y from links union select w.x, l.y from walk w join links l on w.y = l.x),
counted as (select x, count(*) as n_links from links group by x),
reached as (select w.x, min(r.vec_id) as low from walk w join read r on r.nth = w.y group by w.x)
select vec_id, coalesce(n_links, 0) as n_links, least(vec_id, low) as component_id,
    vec_id is not distinct from least(vec_id, low) as kept
from read left join counted on nth = counted.x left join reached on nth = reached.x"""
