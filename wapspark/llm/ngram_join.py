"""N-gram Jaccard self-join by vertical partitioning (operator 10).

A document is the set of its distinct n-word shingles as 64-bit hashes; the
set's own hash is the class of all documents with that set. The hash space,
the global n-gram order, is cut into fragments:

1. Every set is cut into its segments, and all segments of a fragment meet in
   one task. There the fragment's part of each overlap is counted: how many
   n-grams of the segment another document holds, and how many hold each.
2. The counts of a document's segments are summed. A set with a partner of
   Jaccard t shares at least t of its own n-grams, so all others end here,
   without a pair having been formed.
3. What is left is ordered by frequency class and hash. Two sets at t or more
   share one of their first (size - t * size + 1) n-grams, so components over
   those n-grams hold every pair that can link.
4. A component is cut into blocks of bounded size, and blocks that share an
   n-gram of step 3 meet in a tile. A tile counts the overlap of all its pairs
   fragment by fragment and sums per pair; only one tree of links and the
   number of links of each set leave it, so a group of thousands of near
   copies is never written as pairs.
5. Components of the trees' edges give the groups.

Sets carry 40 bits of each hash beside the fragment's bits (46 and more in
all): the chance that two given sets of 500 n-grams miscount is under 1e-8.

Defined results: a null or empty text, or one without words, has no n-grams,
links with nothing and is its own component; fewer words than n make one
shingle; a null id is carried through and never names a component unless its
class has no other; rows are linked by their text, so repeated rows share a
component; columns beyond the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.llm import words as W
from wapspark.llm.components import connected_components
from wapspark.session import ensure_checkpoint_dir

# Text of one map step's blobs, sets of one block, n-grams of one block, and
# columns of one dense count.
BLOB_BYTES = 1 << 21
BLOCK_SETS = 512
BLOCK_GRAMS = 1 << 20
COUNT_COLUMNS = 4096

_SEGMENTS, _DOCS = 0, 1
_BLOB = ("key int, kind int, frag int, a binary, b binary, c binary, lo binary, hi binary, "
         "cls binary")
_ROWS = "kind int, doc_id long, node long, size long, grams binary"


def _need(size, percent):
    """Least number of its own n-grams that a set shares with a partner."""
    return (percent * size + 99) // 100


def _sets(chunk: W.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk's texts, ascending within each row,
    and the rows' bounds."""
    w = W.words(chunk, lower=True)
    whole = W.windows(w.hash, n)
    parts, bounds = [], [0]
    for r in range(chunk.rows):
        lo, hi = w.per_row[r], w.per_row[r + 1]
        if hi - lo >= n:
            parts.append(np.unique(whole[lo:hi - n + 1]))
        elif hi > lo:
            parts.append(W.mix(W.windows(w.hash[lo:hi], hi - lo) + W.MULT * np.uint64(hi - lo)))
        bounds.append(bounds[-1] + (len(parts[-1]) if hi > lo else 0))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(bounds)


def _blob_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 6
    names = [x.split()[0] for x in _BLOB.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(col, kind) for col, kind in zip(zip(*rows), kinds)], names=names)


def _cut(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fragment and the 40 bits after it of each hash."""
    return ((grams >> np.uint64(64 - bits)).astype(np.uint32),
            (grams << np.uint64(bits)) >> np.uint64(24))


def _split40(x: np.ndarray) -> tuple[bytes, bytes]:
    return x.astype(np.uint32).tobytes(), (x >> np.uint64(32)).astype(np.uint8).tobytes()


def _join40(lo: bytes, hi: bytes) -> np.ndarray:
    return (np.frombuffer(lo, np.uint32).astype(np.uint64)
            | np.frombuffer(hi, np.uint8).astype(np.uint64) << np.uint64(32))


def _segment_blobs(n: int, bits: int):
    """Step 1, map side: a blob of segments for each fragment and chunk, and a
    blob of the documents' ids, sizes and classes."""
    @W.give_back
    def run(batches):
        seen: set[int] = set()
        made = 0
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1), BLOB_BYTES):
                grams, bounds = _sets(chunk, n)
                size = np.diff(bounds)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mix(grams))))
                node = W.mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(np.uint64))
                ids = batch.column(0).slice(chunk.first, chunk.rows)
                known = ~np.asarray(ids.is_null())
                rows = [(made % (1 << bits), _DOCS, None,
                         np.asarray(ids.fill_null(0)).astype(np.int64).tobytes(),
                         size.astype(np.uint32).tobytes(), node.tobytes(),
                         known.astype(np.uint8).tobytes(), None, None)]
                made += 1
                fresh = np.zeros(chunk.rows, bool)
                for r, x in enumerate(node.tolist()):
                    if size[r] and x not in seen:
                        seen.add(x)
                        fresh[r] = True
                row = np.repeat(np.arange(chunk.rows), size)
                keep = fresh[row]
                frag, rest = _cut(grams[keep], bits)
                order = np.argsort(frag, kind="stable")
                frag, rest, row = frag[order], rest[order], row[keep][order]
                first = np.flatnonzero(np.concatenate(
                    ([True], (frag[1:] != frag[:-1]) | (row[1:] != row[:-1])))) if len(row) else []
                ends = np.append(first, len(row)).astype(np.int64)
                seg_frag, seg_row = frag[ends[:-1]], row[ends[:-1]]
                for f in np.unique(seg_frag).tolist():
                    s, e = np.searchsorted(seg_frag, [f, f + 1])
                    r = seg_row[s:e]
                    rows.append((f, _SEGMENTS, f, node[r].tobytes(),
                                 size[r].astype(np.uint32).tobytes(),
                                 np.diff(ends[s:e + 1]).astype(np.uint32).tobytes(),
                                 *_split40(rest[ends[s]:ends[e]]), None))
                yield _blob_rows(rows)
    return run


def _gather(table: pa.Table, kind: int, name: str, dtype) -> np.ndarray:
    rows = table.column(name).to_pylist()
    kinds = table.column("kind").to_pylist()
    parts = [np.frombuffer(x, dtype) for x, k in zip(rows, kinds) if k == kind]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _segments(table: pa.Table):
    return (_gather(table, _SEGMENTS, "a", np.uint64), _gather(table, _SEGMENTS, "b", np.uint32),
            _gather(table, _SEGMENTS, "c", np.uint32).astype(np.int64),
            _gather(table, _SEGMENTS, "lo", np.uint32).astype(np.uint64)
            | _gather(table, _SEGMENTS, "hi", np.uint8).astype(np.uint64) << np.uint64(32))


def _count_fragment(bits: int):
    """Step 1, reduce side: of every segment the n-grams that other sets hold
    too, each with its frequency class, sent on by set."""
    def run(key, table):
        node, size, count, rest = _segments(table)
        rows = [(r["key"], _DOCS, None, r["a"], r["b"], r["c"], r["lo"], None, None)
                for r in table.to_pylist() if r["kind"] == _DOCS]
        if len(node):
            # A set sent by several map tasks counts once.
            one = np.zeros(len(node), bool)
            one[np.unique(node, return_index=True)[1]] = True
            rest = rest[np.repeat(one, count)]
            node, size, count = node[one], size[one], count[one]
            order = np.argsort(rest)
            first = np.flatnonzero(np.concatenate(([True], rest[order[1:]] != rest[order[:-1]])))
            df = np.diff(np.append(first, len(rest)))
            cls = np.zeros(len(rest), np.uint8)
            cls[order] = np.repeat((np.frexp(df)[1] - 1).astype(np.uint8), df)
            seg = np.repeat(np.arange(len(node)), count)[cls > 0]
            rest, cls = rest[cls > 0], cls[cls > 0]
            shared = np.bincount(seg, minlength=len(node))
            some = np.flatnonzero(shared)
            bucket = (node[some] % np.uint64(1 << bits)).astype(np.uint32)
            some = some[np.argsort(bucket, kind="stable")]
            bucket = (node[some] % np.uint64(1 << bits)).astype(np.uint32)
            starts = np.concatenate(([0], np.cumsum(shared)))
            for b in np.unique(bucket).tolist():
                s, e = np.searchsorted(bucket, [b, b + 1])
                own = some[s:e]
                at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in own])
                rows.append((b, _SEGMENTS, key[0].as_py(), node[own].tobytes(),
                             size[own].tobytes(), shared[own].astype(np.uint32).tobytes(),
                             *_split40(rest[at]), cls[at].tobytes()))
        if not rows:
            return pa.Table.from_batches([_blob_rows([(0, _DOCS, *[None] * 7)]).slice(0, 0)])
        return pa.Table.from_batches([_blob_rows(rows)])
    return run


def _sum_sets(percent: int):
    """Step 2: sums a set's counts over its segments and keeps the n-grams of
    sets that can have a partner, in the order of step 3; unpacks documents."""
    def run(key, table):
        node, size, count, rest = _segments(table)
        frags = np.array([r for r, k in zip(table.column("frag").to_pylist(),
                                            table.column("kind").to_pylist()) if k == _SEGMENTS],
                         np.uint64)
        per_blob = [len(x) // 4 for x, k in zip(table.column("lo").to_pylist(),
                                                table.column("kind").to_pylist())
                    if k == _SEGMENTS]
        grams = np.repeat(frags, per_blob) << np.uint64(40) | rest
        cls = _gather(table, _SEGMENTS, "cls", np.uint8)
        sets, first, inv = np.unique(node, return_index=True, return_inverse=True)
        shared = np.bincount(inv, weights=count, minlength=len(sets)).astype(np.int64)
        able = shared >= _need(size[first].astype(np.int64), percent)
        owner = np.repeat(inv, count)
        keep = able[owner] if len(owner) else np.zeros(0, bool)
        owner, grams, cls = owner[keep], grams[keep], cls[keep]
        order = np.lexsort((grams, cls, owner))
        grams, ends = grams[order], np.searchsorted(owner[order], np.arange(len(sets) + 1))
        at = np.flatnonzero(able)
        ids = _gather(table, _DOCS, "a", np.int64)
        known = _gather(table, _DOCS, "lo", np.uint8) > 0
        n_docs = len(ids)
        doc_size = _gather(table, _DOCS, "b", np.uint32).astype(np.int64)
        doc_node = _gather(table, _DOCS, "c", np.uint64).view(np.int64)
        return pa.table({
            "kind": pa.array(np.repeat([_DOCS, _SEGMENTS], [n_docs, len(at)]), pa.int32()),
            "doc_id": pa.array(np.concatenate((ids, np.zeros(len(at), np.int64))), pa.int64(),
                               mask=np.concatenate((~known, np.ones(len(at), bool)))),
            "node": pa.array(np.concatenate((doc_node, sets[at].view(np.int64))), pa.int64(),
                             mask=np.concatenate((doc_size == 0, np.zeros(len(at), bool)))),
            "size": pa.array(np.concatenate((doc_size, size[first][at].astype(np.int64)))),
            "grams": pa.array([None] * n_docs + [grams[ends[i]:ends[i + 1]].tobytes() for i in at],
                              pa.binary())})
    return run


def _prefixes(percent: int):
    """Step 3: each set's shared n-grams among its first ones."""
    def run(batches):
        for batch in batches:
            node, gram = [], []
            for x, size, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own = np.frombuffer(blob, np.int64)
                own = own[:len(own) - _need(size, percent) + 1]
                node.append(np.full(len(own), x, np.int64))
                gram.append(own)
            if node:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(gram)), pa.array(np.concatenate(node))],
                    names=["gram", "node"])
    return run


def count_overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Overlaps of all pairs of ``sets`` (arrays of distinct n-grams): the
    order is cut into fragments, each counted on its own, and summed."""
    total = np.zeros((len(sets), len(sets)), np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = df[column] > 1
    owner, column = owner[keep], np.cumsum(df > 1)[column[keep]] - 1
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n = int((df > 1).sum())
    for lo in range(0, n, COUNT_COLUMNS):
        s, e = np.searchsorted(column, [lo, lo + COUNT_COLUMNS])
        part = np.zeros((len(sets), min(COUNT_COLUMNS, n - lo)), np.float32)
        part[owner[s:e], column[s:e] - lo] = 1
        total += (part @ part.T).astype(np.int64)
    return total


def _tile(percent: int):
    """Step 4: links of a tile as each set's least set in reach, and their
    number. A tile of two blocks counts only pairs across them."""
    def run(key, table):
        table = table.sort_by("node")
        node = table.column("node").to_numpy()
        size = table.column("size").to_numpy().astype(np.int64)
        salt = table.column("salt").to_numpy()
        overlap = count_overlaps([np.frombuffer(x, np.int64)
                                  for x in table.column("grams").to_pylist()])
        union = size[:, None] + size[None, :] - overlap
        link = 100 * overlap >= percent * union
        np.fill_diagonal(link, False)
        if key[1].as_py() != key[2].as_py():
            link &= salt[:, None] != salt[None, :]
        label = np.arange(len(node))
        while True:
            reach = np.minimum(label, np.where(link, label[None, :], len(node)).min(axis=1))
            if (reach == label).all():
                break
            label = reach
        count = link.sum(axis=1)
        some = count > 0
        return pa.table({"node": node[some], "parent": node[label][some],
                         "links": count[some].astype(np.int64)})
    return run


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
          percent: int = 85) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (least
    id reachable over links of Jaccard ``percent`` / 100 or more) and
    ``n_links`` (other texts' sets that its set links with)."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (parts - 1).bit_length())
    blobs = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _segment_blobs(n, bits), _BLOB)
    rows = (blobs.groupBy("key").applyInArrow(_count_fragment(bits), _BLOB)
            .groupBy("key").applyInArrow(_sum_sets(percent), _ROWS).checkpoint())
    sets = rows.filter(F.col("kind") == _SEGMENTS).select("node", "size", "grams")
    each = rows.filter(F.col("kind") == _DOCS).select("doc_id", "node", "size")

    prefix = sets.mapInArrow(_prefixes(percent), "gram long, node long").checkpoint()
    least = (prefix.groupBy("gram").agg(F.min("node").alias("least"), F.count("*").alias("df"))
             .filter("df > 1").drop("df"))
    may = connected_components(prefix.join(least, "gram").select("node", "least").distinct())

    sized = sets.select("node", "size").join(may, "node")
    cut = sized.groupBy("root").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_GRAMS)).alias("cut"))
    blocks = (may.join(cut, "root").select(
        "node", "root", "cut", F.pmod(F.xxhash64("node"), "cut").alias("salt")).checkpoint())
    near = (prefix.join(blocks.filter("cut > 1"), "node").select("gram", "root", "salt").distinct())
    pairs = (near.alias("x").join(near.alias("y"), ["gram", "root"]).filter("x.salt <= y.salt")
             .select("root", F.col("x.salt").alias("s"), F.col("y.salt").alias("t")))
    tiles = pairs.union(blocks.select("root", "salt", "salt")).distinct()
    members = tiles.select("root", "s", "t", F.explode(
        F.array_distinct(F.array("s", "t"))).alias("salt"))
    links = (members.join(blocks.join(sets, "node"), ["root", "salt"])
             .select("root", "s", "t", "salt", "node", "size", "grams")
             .groupBy("root", "s", "t")
             .applyInArrow(_tile(percent), "node long, parent long, links long").checkpoint())

    roots = connected_components(links.select("node", "parent"))
    count = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    own = each.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("own"))
    own = (own.join(roots, "node", "left").join(count, "node", "left")
           .select("node", F.coalesce("root", "node").alias("root"), "own",
                   F.coalesce("n_links", F.lit(0)).alias("n_links")).checkpoint())
    first = (own.join(roots.select("root").distinct(), "root").groupBy("root")
             .agg(F.min("own").alias("least")))
    named = own.join(first, "root", "left").select(
        "node", F.coalesce("least", "own").alias("component_id"), "n_links")
    return each.join(named, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def oracle_sql(table: str, n: int = 4, percent: int = 85) -> str:
    """DuckDB SQL for ``group``: overlaps of all pairs of sets that share an
    n-gram, then all that is in reach."""
    return f"""
with recursive cut as (
    select row_number() over () as nth, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from {table}),
grams as (
    select nth, doc_id, list_sort(list_distinct(case when len(w) = 0 then []
        when len(w) < {n} then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) end)) as g
    from cut),
named as (select nth, doc_id, len(g) as size, case when len(g) > 0 then md5(array_to_string(g, chr(10))) end as node
          from grams),
node as (select any_value(nth) as nth, node, min(doc_id) as own from named where node is not null group by node),
held as (select node, unnest(g) as gram, len(g) as size from grams join node using (nth)),
pair as (
    select a.node as x, b.node as y, count(*) as shared, any_value(a.size) as sx, any_value(b.size) as sy
    from held a join held b using (gram) where a.node <> b.node group by a.node, b.node),
links as (select x, y from pair where 100 * shared >= {percent} * (sx + sy - shared)),
walk(x, y) as (select x, y from links union select k.x, l.y from walk k join links l on k.y = l.x),
counted as (select x, count(*) as n_links from links group by x),
reached as (select k.x, min(own) as low from walk k join node on k.y = node.node group by k.x)
select doc_id, size as n_shingles, coalesce(least(own, low), doc_id) as component_id,
    coalesce(n_links, 0) as n_links
from named left join node using (node) left join counted on node = counted.x
    left join reached on node = reached.x"""
