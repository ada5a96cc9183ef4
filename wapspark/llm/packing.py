"""Packing by cutting-stock column generation (operator 3).

Documents become token ids with an end id. Runs of a whole sequence's length
fill a sequence each; what remains of a document is an item:

* the items' length histogram over fixed classes (a bounded table) goes to one
  small task, where a linear program over packing patterns is solved by column
  generation: a knapsack dynamic program over the duals prices new patterns;
* whole parts of the solution are used as they are, the few items left by
  rounding get patterns first-fit, and all patterns are laid out as sequences;
* items ranked within their class (a distributed rank) take the slots;
* some documents are kept out of the program, and their remainders are cut
  freely over the gaps that the classes and patterns leave, by matching running
  totals of gaps and of cut tokens. What is over fills sequences of its own, the
  last of them as powers of two. Documents fall into sixteen shares by a hash of
  their id; so many shares are cut that their tokens fill the gaps, which the
  histogram tells (``CUT_SHARES`` at most, whose ids are carried along).

Ids are those of the tokenizer file's own settings: a text that holds one of
its added tokens goes through the library whole.

Every task reads bounded parts: ranks are range-partitioned, a sequence holds
at most its length in items. Defined results: a null or empty text is the end
id alone; rows with null or repeated ids are packed like any other row; an
empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wapspark.llm import words as W
from wapspark.llm.pretokens import PretokenCache, valid_chunk
from wapspark.operators.ranking import rank_positions
from wapspark.session import ensure_checkpoint_dir

SHARES = 16          # of documents, by a hash of their ids
CUT_SHARES = 4       # so many of them at most are cut freely
LP_GAP = 0.005       # share of the sequences by which more pricing could gain at most
LP_ROUNDS = 200
LP_PATIENCE = 15     # rounds without such a gain after which it stops, too


def length_classes(capacity: int) -> np.ndarray:
    """Upper lengths of the classes: every length up to 32, then 16 a doubling
    until steps of a 64th of the capacity."""
    sizes, step = [], 1
    while not sizes or sizes[-1] < capacity:
        sizes.append((sizes[-1] if sizes else 0) + step)
        if sizes[-1] >= 32 * step and step < capacity // 64:
            step *= 2
    sizes[-1] = capacity
    return np.array(sizes, np.int64)


def price(sizes: np.ndarray, value: np.ndarray, capacity: int):
    """Unbounded knapsack over the duals: the greatest value of a pattern, and
    for every class the best pattern that holds it."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for w in range(1, capacity + 1):
        best[w] = best[w - 1]
        k = fitting[w]
        if k:
            got = best[w - sizes[:k]] + value[:k]
            c = int(got.argmax())
            if got[c] > best[w] + 1e-12:
                best[w], taken[w] = got[c], c
    patterns = np.eye(len(sizes), dtype=np.int64)
    for c, pattern in enumerate(patterns):
        w = capacity - int(sizes[c])
        while w > 0:
            if taken[w] < 0:
                w -= 1
            else:
                pattern[taken[w]] += 1
                w -= int(sizes[taken[w]])
    return best[capacity], patterns


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int):
    """Patterns (rows: items of each class) and how often to use each, meeting
    ``demand`` exactly: the linear program's whole parts, then first-fit."""
    used = np.flatnonzero(demand)
    if not len(used):
        return np.zeros((0, len(sizes)), np.int64), np.zeros(0, np.int64)
    s, need = sizes[used], demand[used].astype(float)
    # A small uneven surplus keeps the program from turning on the spot.
    need += 0.05 * (1 + np.modf(np.arange(1, len(s) + 1) * 0.6180339887)[0])
    basis = np.diag((capacity // s).astype(float))
    inverse, x = np.linalg.inv(basis), need / np.diag(basis)
    seen: list[float] = []
    bound = need @ s / capacity  # no pattern holds more than it can
    for _ in range(LP_ROUNDS):
        dual = inverse.sum(axis=0)
        value, columns = price(s, np.maximum(dual, 0), capacity)
        # The duals over the best value are feasible: a bound from below.
        bound = max(bound, np.maximum(dual, 0) @ need / value)
        seen.append(x.sum())
        still = len(seen) > LP_PATIENCE and seen[-1] > (1 - LP_GAP) * seen[-1 - LP_PATIENCE]
        if still or seen[-1] <= (1 + LP_GAP) * bound:
            break
        for _ in range(4 * len(s)):
            gain = columns @ inverse.sum(axis=0)
            best = int(gain.argmax())
            if gain[best] <= 1 + 1e-7:
                break
            direction = inverse @ columns[best]
            x = np.maximum(inverse @ need, 0)
            ratio = np.where(direction > 1e-9, x / np.maximum(direction, 1e-9), np.inf)
            out = int(ratio.argmin())
            basis[:, out] = columns[best]
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
        inverse = np.linalg.inv(basis)
        x = np.maximum(inverse @ need, 0)
    times = np.floor(np.maximum(x, 0) + 1e-9).astype(np.int64)
    whole = basis.T.astype(np.int64)
    rest = demand[used] - whole.T @ times
    over = rest < 0  # a rounding error at most: give such patterns back
    while over.any():
        p = int(np.argmax((whole[:, over] > 0).any(axis=1) & (times > 0)))
        times[p] -= 1
        rest += whole[p]
        over = rest < 0
    bins: list[np.ndarray] = []
    room: list[int] = []
    for c in range(len(s) - 1, -1, -1):
        left = int(rest[c])
        for b in range(len(bins)):
            fit = min(left, room[b] // int(s[c]))
            bins[b][c] += fit
            room[b] -= fit * int(s[c])
            left -= fit
        while left:
            fit = min(left, capacity // int(s[c]))
            bins.append(np.eye(len(s), dtype=np.int64)[c] * fit)
            room.append(capacity - fit * int(s[c]))
            left -= fit
    patterns = np.concatenate((whole[times > 0], np.array(bins, np.int64).reshape(-1, len(s))))
    out = np.zeros((len(patterns), len(sizes)), np.int64)
    out[:, used] = patterns
    return out, np.concatenate((times[times > 0], np.ones(len(bins), np.int64)))


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class _Tokens:
    """A tokenizer file as a worker holds it; distinct pre-tokens go through
    the library once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.cache = PretokenCache(self._parts)

    def _parts(self, parts: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8") for p in parts]
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _text(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def chunk(self, chunk: W.Chunk):
        chunk = valid_chunk(chunk)
        return self.cache.row_ids(chunk, self._text, self._holds_added(chunk))

    def _holds_added(self, chunk: W.Chunk) -> np.ndarray:
        """Rows with an added token in their text: the library finds these
        before it cuts pre-tokens."""
        held, data = np.zeros(chunk.rows, bool), chunk.data.tobytes()
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                row = int(np.searchsorted(chunk.offsets, at, side="right")) - 1
                held[row] |= at + len(token) <= chunk.offsets[row + 1]
                # A row that is found needs no further look.
                at = data.find(token, int(chunk.offsets[row + 1]) if held[row] else at + 1)
        return held


_held: dict[str, _Tokens] = {}


def _tokenize(path: str, end_id: int, capacity: int):
    @W.give_back
    def run(batches):
        if path not in _held:
            _held[path] = _Tokens(path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1)):
                ids, bounds = _held[path].chunk(chunk)
                names = batch.column(0).slice(chunk.first, chunk.rows)
                sizes, sums, share, cut = [], [], [], []
                for r, name in enumerate(names.to_pylist()):
                    own = np.concatenate((ids[bounds[r]:bounds[r + 1]], end)).astype("<u4")
                    sizes.append(len(own))
                    sums.append([zlib.crc32(own[k:k + capacity].tobytes())
                                 for k in range(0, len(own), capacity)])
                    rest = own[len(own) - len(own) % capacity:]
                    part = zlib.crc32(str(name).encode()) % SHARES
                    share.append(part)
                    cut.append(rest.tobytes() if part < CUT_SHARES and len(rest) else None)
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64())),
                     pa.array(share, pa.int32()), pa.array(cut, pa.binary())],
                    names=["doc_id", "doc_tokens", "crcs", "share", "cut"])
    return run


_SLOTS = "class int, lo long, hi long, per long, base long, end long"


def _solve(sizes: np.ndarray, capacity: int):
    """The program over a histogram, as slots: items ``lo`` to ``hi`` of a
    class stand ``per`` by ``per`` in sequences from ``base`` on. One small
    task, where linear algebra runs on one thread."""
    def run(batches):
        demand = np.zeros(len(sizes), np.int64)
        for batch in batches:
            demand[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
        patterns, times = cutting_stock(sizes, demand, capacity)
        base = np.concatenate(([0], np.cumsum(times))).astype(np.int64)
        rows = []
        for c in range(len(sizes)):
            lo = 0
            for p in np.flatnonzero(patterns[:, c]).tolist():
                per = int(patterns[p, c])
                hi = lo + per * int(times[p])
                rows.append((c, lo, hi, per, int(base[p]), int(base[-1])))
                lo = hi
        names = [x.split()[0] for x in _SLOTS.split(", ")]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int32() if k == 0 else pa.int64())
                 for k, x in enumerate(zip(*rows))], names=names)
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    rows = narrow.mapInArrow(_tokenize(tokenizer, end_id, capacity),
                             "doc_id long, doc_tokens long, crcs array<long>, share int, cut binary")
    rows = rows.withColumn("uid", F.monotonically_increasing_id()).checkpoint()
    rows = (rows.withColumn("whole", F.expr(f"doc_tokens div {capacity}"))
            .withColumn("rest", F.expr(f"doc_tokens % {capacity}")))
    item = rows.filter("rest > 0").select(
        "uid", "doc_id", "doc_tokens", "rest", (F.col("whole") * capacity).alias("from"),
        F.element_at("crcs", -1).alias("crc"), "share", "cut")

    # Classes of the items, their histogram, the program, and its slots.
    sizes = length_classes(capacity)
    slots_of = F.lit([int(x) for x in sizes])
    classed = item.withColumn("class", F.size(F.filter(slots_of, lambda x: x < F.col("rest"))))
    # A row a class and share: bounded.
    histogram = classed.groupBy("class", F.least("share", F.lit(CUT_SHARES)).alias("share")).agg(
        F.count("*").alias("n"), F.sum("rest").alias("tokens")).collect()
    for cut_shares in range(1, CUT_SHARES + 1):
        demand = {}
        for r in histogram:
            if r["share"] >= cut_shares:
                demand[r["class"]] = demand.get(r["class"], 0) + r["n"]
        slots = (spark.createDataFrame(sorted(demand.items()), "class int, n long").coalesce(1)
                 .mapInArrow(_solve(sizes, capacity), _SLOTS).collect())
        packed = sum(r["tokens"] for r in histogram if r["share"] >= cut_shares)
        free_tokens = sum(r["tokens"] for r in histogram if r["share"] < cut_shares)
        if free_tokens >= max((r["end"] for r in slots), default=0) * capacity - packed:
            break
    fixed = classed.filter(F.col("share") >= cut_shares)
    loose = item.filter(F.col("share") < cut_shares)
    n_packed = max((r["end"] for r in slots), default=0)
    slot = spark.createDataFrame(slots, _SLOTS)

    ranked = rank_positions(fixed.drop("cut", "share"), [F.col("rest").desc(), F.col("uid").asc()],
                            ["class"], prefix="k")
    placed = (ranked.join(F.broadcast(slot), "class")  # a bounded table: classes x patterns
              .filter("k_before >= lo and k_before < hi")
              .withColumn("sequence_id", F.expr("base + (k_before - lo) div per")).drop("end"))
    order = Window.partitionBy("sequence_id").orderBy(F.col("rest").desc(), "uid")
    placed = placed.withColumn("offset", F.sum("rest").over(order) - F.col("rest")).checkpoint()
    kept = placed.select("doc_id", F.col("from").alias("start"), F.col("rest").alias("length"),
                         F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

    # Gaps and freely cut items on one line of running totals.
    gaps = (placed.groupBy("sequence_id").agg(F.sum("rest").alias("used"))
            .withColumn("room", F.lit(capacity) - F.col("used")).filter("room > 0"))
    gaps = rank_positions(gaps, [F.col("sequence_id").asc()], weight="room", prefix="g").select(
        "sequence_id", F.col("used").alias("at"), F.col("g_before").alias("g0"),
        (F.col("g_before") + F.col("room")).alias("g1"))
    free = rank_positions(loose.select("uid", "rest"),
                          [F.col("uid").asc()], weight="rest", prefix="f").select(
        "uid", F.col("f_before").alias("f0"), (F.col("f_before") + F.col("rest")).alias("f1"))
    n_gap = gaps.agg(F.max("g1")).first()[0] or 0
    n_free = free.agg(F.max("f1")).first()[0] or 0
    over = max(0, n_free - n_gap)
    n_own, tail = over // capacity, powers_of_two(over % capacity)
    own = spark.range(n_own).select(
        (F.col("id") + n_packed).alias("sequence_id"), F.lit(0).cast("long").alias("at"),
        (F.col("id") * capacity + n_gap).alias("g0"),
        ((F.col("id") + 1) * capacity + n_gap).alias("g1"))
    last, at = [], n_gap + n_own * capacity
    for k, length in enumerate(tail):
        last.append((n_packed + n_own + k, 0, at, at + length))
        at += length
    line = gaps.union(own).union(
        spark.createDataFrame(last, "sequence_id long, at long, g0 long, g1 long"))
    cell = lambda a, b: F.explode(F.sequence(F.expr(f"{a} div {capacity}"),
                                             F.expr(f"({b} - 1) div {capacity}"))).alias("cell")
    met = (line.select("*", cell("g0", "g1")).join(free.select("*", cell("f0", "f1")), "cell")
           .withColumn("lo", F.greatest("g0", "f0")).withColumn("hi", F.least("g1", "f1"))
           .filter(f"lo < hi and lo div {capacity} = cell"))
    cut = met.join(loose, "uid").select(
        "doc_id", (F.col("from") + F.col("lo") - F.col("f0")).alias("start"),
        (F.col("hi") - F.col("lo")).alias("length"),
        F.expr("crc32(substring(cut, cast(4 * (lo - f0) + 1 as int), cast(4 * (hi - lo) as int)))")
        .alias("ids_crc32"), "doc_tokens", "sequence_id",
        (F.col("at") + F.col("lo") - F.col("g0")).alias("offset"))

    full = rank_positions(rows.filter("whole > 0").select(
        "uid", "doc_id", "doc_tokens", "whole", "crcs"), [F.col("uid").asc()],
        weight="whole", prefix="w")
    n_before = n_packed + n_own + len(tail)
    full = (full.select("*", F.posexplode(F.expr("slice(crcs, 1, cast(whole as int))")))
            .select("doc_id", (F.col("pos") * F.lit(capacity)).cast("long").alias("start"),
                    F.lit(capacity).cast("long").alias("length"), F.col("col").alias("ids_crc32"),
                    "doc_tokens", (F.col("w_before") + F.col("pos") + n_before).alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset")))
    return kept.union(cut).union(full)
