"""Periodic run detection by scale-tiled distribution (operator 11).

A run is a stretch of consecutive words with smallest period q, at least
``times`` periods and ``least`` words long, that no neighbouring word extends.

1. Periods are cut into octaves [lo, 2 lo). For an octave a text is exploded
   into overlapping tiles, one around every P-th word (P = 2 lo): P words
   before that boundary and 2 P after it. A run of the octave holds a boundary
   at least a period before its end, so some tile sees it.
2. A tile is solved from its own words alone. For every period of the octave
   its boundary's Z-functions give how far the words agree with those q later,
   to the right and to the left: an interval fragment of period q. Powers
   (fragments whose first q words are themselves periodic) go at once, so a
   text of one repeated word yields fragments of period 1 only.
3. Fragments are shuffled by document and period and stitched: those that
   share q words or more are one run. Only a run's length is left to check.
4. Runs meet their text again, which drops the words that a run repeats.

Z-values come from hashes of 1, 2, 4, ... words (non-linear at each doubling,
so no constructed text makes two blocks agree) by binary descent; two
different blocks agree with a chance of 2**-64. Tiles of many short texts are
solved together in numpy; a map task holds one chunk of text (``words``), or
one longer text, and about 8 * log2(words) bytes for each of its words. Only
texts with a fragment are shuffled, and only once for each (id, text).

Defined results: a null or empty text, or one without words, has no run and
collapses to the empty string; rows are told apart by id and text, repeated
rows give repeated results, null ids are carried through; a tie of exponents
goes to the smaller start, then the smaller period; further columns are
ignored. Words are compared byte by byte, case included.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wapspark.llm import words as W
from wapspark.session import ensure_checkpoint_dir

# Least periods of a run; shorter repetitions are no runs.
TIMES = 3
# A boundary's grid of (tile, period) pairs worked on at once.
GRID = 1 << 18

_TEXT, _FRAGMENT = 0, 1
_PARTS = ("kind int, doc_id long, text_key binary, text string, sha string, "
          "period long, start long, end long")


@dataclass(frozen=True)
class Octave:
    """Periods ``lo .. hi - 1``; tiles stand ``step`` words apart and reach
    ``step`` words beyond their boundary's period on either side. A run's
    fragment at any of its boundaries agrees over ``1 << block`` words on one
    side at least."""

    lo: int
    hi: int
    step: int
    block: int


def octaves(words: int, least: int):
    """The octaves of a text of so many words. Periods so small that ``least``
    decides a run's length share the first one."""
    bits = max(1, (least // TIMES).bit_length() - 1)
    # A run of a period under 2**bits holds least - period words from a boundary on.
    lo, hi = 1, 1 << bits
    step = 1 << max(bits, (least - hi + 2).bit_length() - 1)
    reach = (least - hi + 2) // 2
    yield Octave(lo, hi, step, max(0, min(reach, step).bit_length() - 1))
    while TIMES * hi <= words:
        lo, hi = hi, 2 * hi
        yield Octave(lo, hi, hi, lo.bit_length() - 1)


def _doubled(level: np.ndarray, size: int) -> np.ndarray:
    """Hashes of 2 * size words from those of size words, by position; the
    last ones wrap into nothing and are never asked for."""
    out = W.mix(level) * W.MULT
    out[:-size] += level[size:]
    return W.mix(out)


def _agree(levels, x, y, limit, back: bool):
    """Z-values: words that agree from ``x`` and ``y`` on (or before them, for
    ``back``), up to ``limit``."""
    length = np.zeros(len(x), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        at = np.flatnonzero(length + (1 << j) <= limit)
        shift = -(length[at] + (1 << j)) if back else length[at]
        same = levels[j][x[at] + shift] == levels[j][y[at] + shift]
        length[at[same]] += 1 << j
    return length


def _primes(q: int) -> list[int]:
    found, d = [], 2
    while d * d <= q:
        if q % d == 0:
            found.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return found + [q] * (q > 1)


def _primitive(levels, x, period):
    """Whether the ``period`` words from ``x`` on are no power of fewer."""
    good = np.ones(len(x), bool)
    for q in np.unique(period).tolist():
        own = np.flatnonzero(period == q)
        for d in _primes(q):
            shift = q // d
            size = q - shift
            j = size.bit_length() - 1
            a, b, tail = x[own], x[own] + shift, size - (1 << j)
            good[own] &= ~((levels[j][a] == levels[j][b])
                           & (levels[j][a + tail] == levels[j][b + tail]))
    return good


def _pairs(octave: Octave, begin: np.ndarray, count: np.ndarray, level: np.ndarray):
    """Boundaries and periods of an octave whose words agree over a block to
    the right or to the left; position arrays in slices of bounded size."""
    size = 1 << octave.block
    tiles = count // octave.step + 1
    text = np.repeat(np.arange(len(begin)), tiles)
    first = np.cumsum(tiles) - tiles
    c = (np.arange(len(text)) - first[text]) * octave.step
    lo, hi = begin[text], begin[text] + count[text]
    c += lo
    periods = np.arange(octave.lo, octave.hi)
    rows = max(1, GRID // len(periods))
    for s in range(0, len(c), rows):
        at = slice(s, s + rows)
        x, end, start = c[at, None], hi[at, None], lo[at, None]
        y = x + periods[None, :]
        top = len(level) - 1
        right = (y + size <= end) & (level[np.minimum(x, top)] == level[np.minimum(y, top)])
        left = ((x - size >= start) & (y <= end)
                & (level[np.maximum(x - size, 0)] == level[np.clip(y - size, 0, top)]))
        tile, q = np.nonzero(right | left)
        yield c[at][tile], periods[q], lo[at][tile], hi[at][tile], text[at][tile]


def fragments(hashes: np.ndarray, bounds: np.ndarray, least: int):
    """Fragments (text, period, start, end) of the texts whose words' hashes
    lie back to back, text i at ``bounds[i]:bounds[i + 1]``."""
    begin, count = bounds[:-1], np.diff(bounds)
    levels, found = [hashes], []
    for octave in octaves(int(count.max(initial=0)), least):
        long_enough = np.flatnonzero(count >= max(least, TIMES * octave.lo))
        if not len(long_enough):
            break
        while len(levels) < octave.step.bit_length():
            levels.append(_doubled(levels[-1], 1 << (len(levels) - 1))
                          if len(levels[-1]) > 1 << (len(levels) - 1) else levels[-1])
        for c, q, lo, hi, text in _pairs(octave, begin[long_enough], count[long_enough],
                                         levels[octave.block]):
            right = _agree(levels, c, c + q, np.minimum(octave.step, hi - c - q), False)
            left = _agree(levels, c, c + q, np.minimum(octave.step, c - lo), True)
            clipped = (right == octave.step) | (left == octave.step)
            size = left + right + q
            keep = np.flatnonzero(np.where(clipped, size >= 2 * q,
                                           size >= np.maximum(least, TIMES * q)))
            keep = keep[_primitive(levels, (c - left)[keep], q[keep])]
            if len(keep):
                found.append(np.stack([long_enough[text[keep]], q[keep],
                                       (c - left - lo)[keep], (c + q + right - lo)[keep]]))
    return np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)


def _joined(chunk: W.Chunk, w: W.Words) -> list[bytes]:
    """Each text's words joined by one space."""
    keep = np.zeros(len(chunk.data) + 1, np.int64)
    keep[w.start] += 1
    keep[w.end] -= 1
    inside = np.cumsum(keep)[:-1] > 0
    data = chunk.data
    more = np.ones(len(w.end), bool)
    more[w.per_row[1:][np.diff(w.per_row) > 0] - 1] = False  # a text's last word
    gaps = w.end[more]
    if len(gaps):
        data, inside[gaps] = data.copy(), True
        data[gaps] = 0x20
    sizes = np.concatenate(([0], np.cumsum(inside)))[chunk.offsets]
    flat = data[inside].tobytes()
    return [flat[a:b] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist())]


def _find(least: int):
    """Steps 1 and 2: texts without a fragment are ready; the others go on
    with their fragments, under a digest of their words."""
    @W.give_back
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in W.text_chunks(batch.column(1)):
                w = W.words(chunk)
                texts = _joined(chunk, w)
                text, period, start, end = fragments(w.hash, w.per_row, least)
                some = np.zeros(chunk.rows, bool)
                some[text] = True
                sha = [hashlib.sha256(t) for t in texts]
                key = [s.digest()[:16] if x else None for s, x in zip(sha, some)]
                own = ids[chunk.first:chunk.first + chunk.rows]
                n = len(text)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([_TEXT, _FRAGMENT], [chunk.rows, n]), pa.int32()),
                    pa.array(own + [own[t] for t in text.tolist()], pa.int64()),
                    pa.array(key + [key[t] for t in text.tolist()], pa.binary()),
                    pa.array([t.decode() if x else None for t, x in zip(texts, some)]
                             + [None] * n, pa.string()),
                    pa.array([None if x else s.hexdigest() for s, x in zip(sha, some)]
                             + [None] * n, pa.string()),
                    *[pa.array([None] * chunk.rows + x.tolist(), pa.int64())
                      for x in (period, start, end)]],
                    names=[x.split()[0] for x in _PARTS.split(", ")])
    return run


def _stitch(parts: DataFrame, least: int) -> DataFrame:
    """Step 3: runs of each text. A text's fragments of one period, by start:
    one that shares fewer than q words with all before it begins a run."""
    key = ["doc_id", "text_key", "period"]
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cut = (parts.filter(F.col("kind") == _FRAGMENT).select(*key, "start", "end").distinct()
           .withColumn("reach", F.max("end").over(before))
           .withColumn("fresh", F.when(F.col("reach") - F.col("start") >= F.col("period"), 0)
                       .otherwise(1))
           .withColumn("nth", F.sum("fresh").over(upto)))
    return (cut.groupBy(*key, "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .withColumn("length", F.col("end") - F.col("start"))
            .filter(F.col("length") >= F.greatest(F.lit(least), TIMES * F.col("period"))))


def _collapse(batches):
    """Step 4: drops every word that a run holds after its first period."""
    for batch in batches:
        shas = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            own = text.split(" ") if text else []
            edge = np.zeros(len(own) + 1, np.int64)
            for r in runs or []:
                edge[r["start"] + r["period"]] += 1
                edge[r["start"] + r["length"]] -= 1
            kept = " ".join(x for x, d in zip(own, np.cumsum(edge).tolist()) if not d)
            shas.append((kept, hashlib.sha256(kept.encode()).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([k for k, _ in shas], pa.string()),
             pa.array([s for _, s in shas], pa.string())],
            names=[*batch.schema.names, "collapsed", "collapsed_sha256"])


def runs(docs: DataFrame, least: int = 24, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``runs`` (array of start, length,
    period; by start, then period), ``collapsed_sha256`` and, for texts with a
    run, ``collapsed`` (the kept words joined by one space; null elsewhere,
    where it is all words)."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    parts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        _find(least), _PARTS).checkpoint()
    run = "array<struct<start:bigint,length:bigint,period:bigint>>"
    ready = parts.filter((F.col("kind") == _TEXT) & F.col("text_key").isNull()).select(
        "doc_id", F.array().cast(run).alias("runs"), F.lit(None).cast("string").alias("collapsed"),
        F.col("sha").alias("collapsed_sha256"))
    texts = parts.filter((F.col("kind") == _TEXT) & F.col("text_key").isNotNull()).select(
        "doc_id", "text_key", "text", F.lit(1).alias("copies"), F.lit(None).cast(run).alias("runs"))
    found = _stitch(parts, least).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(
        F.struct("start", "length", "period"))).alias("runs"))
    # A text and its runs meet by grouping, which takes null ids as equal.
    met = texts.unionByName(found.withColumns({
        "text": F.lit(None).cast("string"), "copies": F.lit(0)})).groupBy("doc_id", "text_key").agg(
        F.first("text", ignorenulls=True).alias("text"), F.sum("copies").alias("copies"),
        F.first("runs", ignorenulls=True).alias("runs")).select(
        "doc_id", "text", "copies", F.coalesce("runs", F.array().cast(run)).alias("runs"))
    done = met.mapInArrow(_collapse, f"doc_id long, text string, copies long, runs {run}, "
                                     "collapsed string, collapsed_sha256 string")
    # A text's copies come back as so many rows.
    done = done.select("doc_id", "runs", "collapsed", "collapsed_sha256",
                       F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_")).drop("_")
    return ready.unionByName(done)


def digest(found: DataFrame) -> DataFrame:
    """``runs`` as numbers and digests: per row ``doc_id``, ``n_runs``, the
    strongest run, ``runs_sha256``, ``collapsed_sha256``."""
    # Exact comparison of length / period: cross products of whole numbers.
    best = F.aggregate(
        F.col("runs"), F.get("runs", F.lit(0)),
        lambda a, r: F.when((r["length"] * a["period"] > a["length"] * r["period"])
                            | ((r["length"] * a["period"] == a["length"] * r["period"])
                               & (F.struct(r["start"], r["period"])
                                  < F.struct(a["start"], a["period"]))), r).otherwise(a))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), "collapsed_sha256")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` with periodic words planted in the texts whose
    ``crc32(doc_id)`` is divisible by 10: from word a on, the p words there
    repeat. These become their words joined by one space; others stay."""
    h = F.crc32(F.col(id_col).cast("string"))
    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all(
        "text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    held = held.withColumn("words", words).withColumn("n", F.size("words"))
    some = held.filter("n > 0").select(
        "doc_id", "words", "n", F.expr("(h div 10) % n").cast("int").alias("a"),
        F.expr("h div 10").alias("g"))
    some = some.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)").cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")),
                                    F.expr("cast((n - a + p - 1) div p as int)")))
    some = some.select("doc_id", F.array_join(F.concat(
        F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a"))),
        " ").alias("text"))
    return held.filter("n is null or n <= 0").select("doc_id", "text").unionByName(some)
