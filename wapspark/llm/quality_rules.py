"""Quality rules by repetition coverage (operator 7).

Every text is cut into words (runs outside space and 0x09-0x0D). Rolling
hashes of the 5- to 10-word windows and of whole lines mark what stands more
than once in the same text; a text whose marked characters exceed a limit is
rejected. Base counts (words, symbols, equal lines, words in repeated 3-word
windows) come with it. All work is numpy over Arrow buffers, chunk by chunk.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; a null id is carried through; repeated rows are judged one by one;
columns beyond the id and the text are ignored by ``measure`` and carried
through unchanged, whatever their names, by ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wapspark.llm import words as W


@dataclass(frozen=True)
class Limits:
    """A text is kept while no share of its word characters is above a limit.

    The limits lie over what texts labelled good show (at most 0.43 for any
    length of window and for lines) and under what junk shows (half and more).
    """

    window_coverage: dict = field(default_factory=lambda: {5: 0.5, 6: 0.5, 7: 0.5,
                                                           8: 0.5, 9: 0.5, 10: 0.5})
    line_coverage: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NL = 10


def _sum_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive slices; ``bounds`` has one entry more than rows."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether its key occurs again, and whether it is a later one."""
    n = len(keys)
    if n == 0:
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later = np.zeros(n, bool)
    later[order[1:]] = same
    several = later.copy()
    several[order[:-1]] |= same
    return several, later


def _covered(several: np.ndarray, size: int, n_words: int) -> np.ndarray:
    """Words inside a marked window of ``size`` words."""
    steps = np.zeros(n_words + 1, np.int32)
    at = np.flatnonzero(several)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps[:-1]) > 0


def _lines(chunk: W.Chunk):
    """Start, end and row of every line that has a byte."""
    n = len(chunk.data)
    nl = np.flatnonzero(chunk.data == _NL)
    start = np.unique(np.concatenate((chunk.offsets[:-1], nl + 1)))
    start = start[start < n]
    row = np.searchsorted(chunk.offsets, start, side="right") - 1
    following = np.concatenate((nl, [n]))[np.searchsorted(nl, start)]
    return start, np.minimum(following, chunk.offsets[row + 1]), row


def measure_chunk(chunk: W.Chunk, limits: Limits) -> dict[str, np.ndarray]:
    """All measures of the texts of a chunk, one entry a row."""
    w = W.words(chunk)
    bounds, n = w.per_row, len(w.start)
    points = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80, dtype=np.int64)))
    chars = points[w.end] - points[w.start]
    out = {"n_words": np.diff(bounds), "word_chars": _sum_by_row(chars, bounds),
           "n_symbols": _sum_by_row(_SYMBOL[chunk.data], chunk.offsets)}

    start, end, row = _lines(chunk)
    sums = np.concatenate(([0], np.cumsum(chars)))
    lo, hi = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    with_word = hi > lo
    start, end, row, lo, hi = (x[with_word] for x in (start, end, row, lo, hi))
    several, later = _repeats(W.span_hashes(chunk, start, end) ^ W.mix(row))
    per_line = np.searchsorted(row, np.arange(chunk.rows + 1))
    out["n_dup_lines"] = _sum_by_row(later, per_line)
    line_chars = _sum_by_row(np.where(several, sums[hi] - sums[lo], 0), per_line)
    total = np.maximum(out["word_chars"], 1)
    out["line_coverage"] = line_chars / total

    salt = W.mix(w.row)
    rolling = np.zeros(n, np.uint64)
    kept = out["line_coverage"] <= limits.line_coverage
    for size in range(1, max([3, *limits.window_coverage]) + 1):
        m = n - size + 1
        if m > 0:
            rolling = rolling[:m] * W.MULT + w.hash[size - 1:]
        if size != 3 and size not in limits.window_coverage:
            continue
        if m > 0:
            whole = np.flatnonzero(w.row[:m] == w.row[size - 1:])
            marked = np.zeros(m, bool)
            marked[whole] = _repeats(W.mix(rolling[whole]) ^ salt[whole])[0]
            covered = _covered(marked, size, n)
        else:
            covered = np.zeros(n, bool)
        if size == 3:
            out["n_repeat_words"] = _sum_by_row(covered, bounds)
        if size in limits.window_coverage:
            share = _sum_by_row(np.where(covered, chars, 0), bounds) / total
            out[f"coverage_{size}"] = share
            kept &= share <= limits.window_coverage[size]
    out["base_failed"] = ((out["n_words"] < limits.min_words)
                          | (100 * out["n_repeat_words"] > limits.max_repeat_percent * out["n_words"]))
    out["kept"] = kept & ~out["base_failed"]
    return out


def _fields(limits: Limits) -> list[T.StructField]:
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shares = ["line_coverage", *[f"coverage_{k}" for k in sorted(limits.window_coverage)]]
    return [*[T.StructField(c, T.LongType()) for c in longs],
            *[T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")],
            *[T.StructField(c, T.DoubleType()) for c in shares]]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            limits: Limits = Limits()) -> DataFrame:
    """The id and all measures of every row of ``docs``."""
    narrow = docs.select(id_col, text_col)
    fields = _fields(limits)
    schema = T.StructType([T.StructField(id_col, narrow.schema[id_col].dataType), *fields])

    @W.give_back
    def run(batches):
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1)):
                got = measure_chunk(chunk, limits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows),
                     *[pa.array(got[f.name]) for f in fields]],
                    names=[id_col, *[f.name for f in fields]])

    return narrow.mapInArrow(run, schema)


def keep(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    at = docs.columns.index(text_col)

    @W.give_back
    def run(batches):
        for batch in batches:
            for chunk in W.text_chunks(batch.column(at)):
                mask = measure_chunk(chunk, limits)["kept"]
                if mask.any():
                    yield batch.slice(chunk.first, chunk.rows).filter(pa.array(mask))

    return docs.mapInArrow(run, docs.schema)


def oracle_sql(table: str, limits: Limits = Limits()) -> str:
    """DuckDB SQL for ``measure`` with ``doc_id`` and ``text``: windows as the
    words themselves, joined by a space, which no word holds."""
    sizes = sorted({3, *limits.window_coverage})
    grams = ", ".join(
        f"CASE WHEN p + {k - 1} <= max(p) OVER (PARTITION BY r) THEN array_to_string(list(word) OVER "
        f"(PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING), ' ') END AS g{k}"
        for k in sizes)
    marks = ", ".join(f"g{k} IS NOT NULL AND count(*) OVER (PARTITION BY r, g{k}) > 1 AS m{k}"
                      for k in sizes)
    covered = ", ".join(
        f"bool_or(m{k}) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) "
        f"AS c{k}" for k in sizes)
    sums = ", ".join(f"coalesce(sum(chars) FILTER (c{k}), 0) / greatest(sum(chars), 1)::DOUBLE "
                     f"AS coverage_{k}" for k in sorted(limits.window_coverage))
    names = [f"coverage_{k}" for k in sorted(limits.window_coverage)]
    shares = ", ".join(f"coalesce({c}, 0.0)::DOUBLE AS {c}" for c in names)
    low = " AND ".join(f"{c} <= {limits.window_coverage[int(c[9:])]}" for c in names)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM {table}),
split AS (SELECT r, string_split(t, chr(10)) AS parts FROM d),
lines AS (SELECT r, unnest(range(len(parts))) AS k, unnest(parts) AS line FROM split),
cut AS (SELECT r, k, line, regexp_extract_all(line, '[^ 	-]+') AS ws FROM lines),
full_lines AS (SELECT r, k, line, list_sum(list_transform(ws, lambda x: length(x))) AS chars,
    row_number() OVER (PARTITION BY r, line ORDER BY k) AS nth,
    count(*) OVER (PARTITION BY r, line) AS copies FROM cut WHERE len(ws) > 0),
per_line AS (SELECT r, count(*) FILTER (nth > 1) AS dup,
    coalesce(sum(chars) FILTER (copies > 1), 0) / greatest(sum(chars), 1)::DOUBLE AS share
    FROM full_lines GROUP BY r),
each AS (SELECT r, k, unnest(range(len(ws))) AS j, unnest(ws) AS word FROM cut),
words AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY k, j) AS p, word FROM each),
grams AS (SELECT r, p, length(word) AS chars, {grams} FROM words),
marks AS (SELECT r, p, chars, {marks} FROM grams),
covered AS (SELECT r, chars, {covered} FROM marks),
per_text AS (SELECT r, count(*) AS n_words, sum(chars) AS word_chars,
    count(*) FILTER (c3) AS n_repeat_words, {sums} FROM covered GROUP BY r),
all_rows AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
    coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(share, 0.0)::DOUBLE AS line_coverage, {shares}
    FROM d LEFT JOIN per_text USING (r) LEFT JOIN per_line USING (r)),
judged AS (SELECT *, n_words < {limits.min_words}
    OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed FROM all_rows)
SELECT *, NOT base_failed AND line_coverage <= {limits.line_coverage} AND {low} AS kept FROM judged"""
