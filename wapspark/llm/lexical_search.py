"""Ranked lexical search by presence-mask grouping (operator 12).

Every item of a query table is scored against every document: a term found tf
times in a document of length factor m adds
``weight * ((10**9 tf) div (1000 tf + 12 m))``, once for each time the item
holds it; the ``k`` best documents of an item are returned.

1. Documents become blocks: per block the postings (document, tf) of the terms
   that some item holds, and the sums that make up the global statistics.
   Blocks are checkpointed, so texts are read and cut into terms once.
2. Document frequencies are summed over the blocks and give the weights.
3. Per block and item, the postings of the item's terms become presence
   bitmaps, one row a term; read downwards, a document's bits are its mask.
   Documents are grouped by mask. A mask's maximum score follows from its
   terms' largest tf in the block and its documents' smallest m.
   Masks are evaluated by descending maximum until the next one's is below the
   k-th best score that the task has found for the item. No document that
   could be among the best is left out; equal maxima are still evaluated.
4. Each task's k best of an item are merged by a window over the item, which
   Spark limits to k rows per task before it shuffles them.

The items are taken in blocks of ``ITEM_BYTES`` of text (a longer item is a
block of its own), each answered by its own passes: what goes to the tasks is
bounded by that and not by the items' number. A task holds one block of
documents, ``CELLS`` counts, and k results an item.

Defined results: a null text has no term, a document or item without terms is
never ranked or answered; documents are rows, so repeated rows are ranked
repeatedly; a null ``doc_id`` is ranked after all others of its score; items
equal in id and text are answered once, a null ``item_id`` is kept as it is;
further columns are ignored. Terms are compared by 64-bit hash and length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wapspark.llm import words as W
from wapspark.session import ensure_checkpoint_dir

# Text of the items answered in one pass, text cut into terms at once,
# documents of one block, and counts (term, document) held at once.
ITEM_BYTES = 1 << 22
TEXT_BYTES = 1 << 21
BLOCK_DOCS = 8192
CELLS = 1 << 20

# Bytes between terms: ASCII other than digits and letters.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[:128] = True
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

_BLOCK = ("ids binary, known binary, size binary, term binary, first binary, doc binary, "
          "tf binary, n_docs long, n_terms long")
_FOUND = "item int, doc_id long, score long"


class Items:
    """The distinct terms of some items, by hash, and each item's own with
    their number."""

    def __init__(self, texts: list[str]):
        hashes, sizes, rows = [], [], []
        column = pa.array(texts, pa.large_string())
        for chunk in W.text_chunks(column, TEXT_BYTES):
            w = W.words(chunk, lower=True, outside=_BETWEEN)
            hashes.append(w.hash)
            sizes.append(w.end - w.start)
            rows.append(w.row + chunk.first)
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.hash, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        self.bytes = (np.concatenate(sizes) if sizes else np.zeros(0, np.int64))[first]
        pair, count = np.unique(rows * max(1, len(self.hash)) + inverse, return_counts=True)
        row, term = np.divmod(pair, max(1, len(self.hash)))
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        self.own = [(term[a:b], count[a:b]) for a, b in zip(cut[:-1], cut[1:])]

    def find(self, w: W.Words) -> np.ndarray:
        """The number of each word's term, or -1."""
        if not len(self.hash):
            return np.full(len(w.hash), -1)
        at = np.minimum(np.searchsorted(self.hash, w.hash), len(self.hash) - 1)
        return np.where((self.hash[at] == w.hash) & (self.bytes[at] == w.end - w.start), at, -1)


def _block(parts) -> pa.RecordBatch:
    """One block of several chunks' postings."""
    shift = np.concatenate(([0], np.cumsum([len(p["ids"]) for p in parts])))
    term = np.concatenate([p["term"] for p in parts])
    doc = np.concatenate([p["doc"] + s for p, s in zip(parts, shift)])
    tf = np.concatenate([p["tf"] for p in parts])
    order = np.argsort(term, kind="stable")
    term, first = np.unique(term[order], return_index=True)
    columns = [np.concatenate([p["ids"] for p in parts]).astype(np.int64),
               np.concatenate([p["known"] for p in parts]).astype(np.uint8),
               np.concatenate([p["size"] for p in parts]).astype(np.int64),
               term.astype(np.int32), np.append(first, len(doc)).astype(np.int64),
               doc[order].astype(np.int32), tf[order].astype(np.int32)]
    return pa.RecordBatch.from_arrays(
        [pa.array([c.tobytes()], pa.binary()) for c in columns]
        + [pa.array([sum(p[k] for p in parts)], pa.int64()) for k in ("n_docs", "n_terms")],
        names=[x.split()[0] for x in _BLOCK.split(", ")])


def _postings(items: Items):
    """Step 1: documents as blocks of postings."""
    @W.give_back
    def run(batches):
        held, docs = [], 0
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1), TEXT_BYTES):
                w = W.words(chunk, lower=True, outside=_BETWEEN)
                size = np.diff(w.per_row)
                term = items.find(w)
                hit = term >= 0
                pair, tf = np.unique(term[hit] * chunk.rows + w.row[hit], return_counts=True)
                term, row = np.divmod(pair, chunk.rows)
                some, doc = np.unique(row, return_inverse=True)
                ids = batch.column(0).slice(chunk.first, chunk.rows)
                held.append({"ids": np.asarray(ids.fill_null(0))[some],
                             "known": ~np.asarray(ids.is_null())[some], "size": size[some],
                             "term": term, "doc": doc, "tf": tf,
                             "n_docs": int((size > 0).sum()), "n_terms": int(size.sum())})
                docs += len(some)
                if docs >= BLOCK_DOCS:
                    yield _block(held)
                    held, docs = [], 0
        if held:
            yield _block(held)
    return run


def _frequencies(batches):
    """Step 2: in how many documents of its block each term is."""
    for batch in batches:
        for term, first in zip(batch.column("term").to_pylist(), batch.column("first").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(term, np.int32)),
                 pa.array(np.diff(np.frombuffer(first, np.int64)))], names=["term", "df"])


def masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of columns of ``present`` (terms x documents) that hold the same
    terms: a column of each group, and the group of each column."""
    bits = np.packbits(present, axis=0)
    if len(bits) <= 8:
        wide = np.zeros((bits.shape[1], 8), np.uint8)
        wide[:, :len(bits)] = bits.T
        key = wide.view(np.uint64).ravel()
    else:
        key = np.ascontiguousarray(bits.T).view(np.dtype((np.void, len(bits)))).ravel()
    _, column, group = np.unique(key, return_index=True, return_inverse=True)
    return column, group


def _points(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Best:
    """The k best documents of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    def least(self) -> int:
        """What a document must reach, ties included."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score, ids, known) -> None:
        keep = score >= self.least()
        score = np.concatenate((self.score, score[keep]))
        ids = np.concatenate((self.id, ids[keep]))
        known = np.concatenate((self.known, known[keep]))
        top = np.lexsort((ids, ~known, -score))[:self.k]
        self.score, self.id, self.known = score[top], ids[top], known[top]


def search_block(tf, weight, m, ids, known, best: Best) -> int:
    """Step 3 for one item: ``tf`` (terms x documents), ``weight`` of each term
    with its repeats. Returns the number of documents that were scored."""
    some = np.flatnonzero(tf.any(axis=0))
    tf, m, ids, known = tf[:, some], m[some], ids[some], known[some]
    if not len(some):
        return 0
    column, group = masks(tf > 0)
    smallest = np.full(len(column), np.iinfo(np.int64).max)
    np.minimum.at(smallest, group, m)
    most = np.where(tf[:, column] > 0, _points(tf.max(axis=1)[:, None], smallest[None, :]), 0)
    most = (weight[:, None] * most).sum(axis=0)
    order = np.argsort(-most, kind="stable")
    most = most[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by_mask = np.argsort(place[group], kind="stable")
    ends = np.cumsum(np.bincount(place[group], minlength=len(order)))
    done, mask, step = 0, 0, 2 * best.k
    while mask < len(most) and most[mask] >= best.least():
        # Masks of about so many documents whose maximum reaches what is needed.
        last = int(np.searchsorted(ends, done + step)) + 1
        last = min(last, int(np.searchsorted(-most, -best.least(), side="right")))
        own = by_mask[done:ends[last - 1]]
        score = (weight[:, None] * _points(tf[:, own], m[None, own])).sum(axis=0)
        best.add(score, ids[own], known[own])
        done, mask, step = int(ends[last - 1]), last, 2 * step
    return done


def _rank(items: Items, df: dict, n: int, total: int, k: int):
    weight = np.zeros(len(items.hash), np.int64)
    for t, d in df.items():
        weight[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1)))

    def run(batches):
        best = [Best(k) for _ in items.own]
        for batch in batches:
            for row in batch.to_pylist():
                ids, size, first = (np.frombuffer(row[c], np.int64) for c in ("ids", "size", "first"))
                known = np.frombuffer(row["known"], np.uint8) > 0
                doc, tf = (np.frombuffer(row[c], np.int32) for c in ("doc", "tf"))
                at = np.full(len(weight), -1)
                held = np.frombuffer(row["term"], np.int32)
                at[held] = np.arange(len(held))
                m = 75 + (25 * size * n) // total
                for (own, repeats), top in zip(items.own, best):
                    here = at[own] >= 0
                    if not here.any():
                        continue
                    term, w = at[own[here]], (repeats * weight[own])[here]
                    count = first[term + 1] - first[term]
                    line = np.repeat(np.arange(len(term)), count)
                    skip = np.cumsum(count) - count
                    where = np.arange(len(line)) - skip[line] + first[term][line]
                    step = max(64, CELLS // len(term))
                    for lo in range(0, len(ids), step):
                        hi = min(lo + step, len(ids))
                        cut = (slice(None) if hi - lo == len(ids)
                               else (doc[where] >= lo) & (doc[where] < hi))
                        dense = np.zeros((len(term), hi - lo), np.int64)
                        dense[line[cut], doc[where[cut]] - lo] = tf[where[cut]]
                        search_block(dense, w, m[lo:hi], ids[lo:hi], known[lo:hi], top)
        item = np.repeat(np.arange(len(best)), [len(b.id) for b in best])
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)),
                 pa.array(np.concatenate([b.id for b in best]),
                          mask=~np.concatenate([b.known for b in best])),
                 pa.array(np.concatenate([b.score for b in best]))],
                names=["item", "doc_id", "score"])
    return run


def _item_blocks(items: DataFrame):
    """(ids, texts) of the items in blocks of bounded text, as they stream in."""
    ids, texts, size = [], [], 0
    for r in items.toLocalIterator():
        if ids and size + len(r[1]) > ITEM_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        size += len(r[1]) + 64
    if ids:
        yield ids, texts


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item:
    ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``; ties go to the
    smaller id."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    asked = items.select(F.col(item_col), F.col(item_text_col).cast("string")).filter(
        F.col(item_text_col).isNotNull()).distinct()
    id_type = asked.schema[0].dataType
    found = spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, "
                                      "doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for ids, block in _item_blocks(asked):
        own = Items(block)
        blocks = texts.mapInArrow(_postings(own), _BLOCK).checkpoint()
        n, total = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not total:
            break
        # A row a term of these items, whose text is bounded.
        df = dict(blocks.select("term", "first").mapInArrow(_frequencies, "term int, df long")
                  .groupBy("term").agg(F.sum("df")).collect())
        top = (blocks.mapInArrow(_rank(own, df, n, total, k), _FOUND)
               .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))
        names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)],
                                      f"item int, item_id {id_type.simpleString()}")
        found = found.unionByName(top.join(F.broadcast(names), "item").select(
            "item_id", "rank", "doc_id", "score"))
    return found


def oracle_sql(docs: str, items: str, k: int = 20) -> str:
    """DuckDB SQL for ``search``, every document's every term counted."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = (f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             f"'abcdefghijklmnopqrstuvwxyz'), '{term}')")
    return f"""
with held as (
    select row_number() over () as nth, doc_id, {terms} as terms from {docs} where text is not null),
size as (select count(*) as n, sum(len(terms))::bigint as total from held where len(terms) > 0),
counted as (
    select nth, doc_id, length_, term, count(*) as tf
    from (select nth, doc_id, len(terms) as length_, unnest(terms) as term from held)
    group by all),
weight as (
    select term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::bigint as weight
    from counted, size group by term, n),
asked as (
    select item_id, term, count(*) as repeats
    from (select item_id, unnest({terms}) as term from {items} where text is not null) group by all),
scored as (
    select item_id, nth, doc_id, sum(repeats * weight * ((1000000000 * tf)
        // (1000 * tf + 12 * (75 + (25 * length_ * n) // total))))::bigint as score
    from asked join counted using (term) join weight using (term), size
    group by item_id, nth, doc_id),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank,
           doc_id, score
    from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {k}"""
