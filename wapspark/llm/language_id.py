"""Language identification by cross-parsing (operator 9).

Per language a suffix automaton is built from sample text. A text is parsed
against each: always the longest piece that occurs in the language's sample is
taken as the next phrase. The language that needs the fewest phrases describes
the text best; the logarithm of its sample's length normalises the counts.

A text is parsed word by word (runs of letters, folded to lower case, each with
a space before it, runs of over ``RUN`` letters in pieces), so a phrase never
crosses a word, and a word counted once serves wherever it recurs: a batch's
distinct words go through the automata together, one letter at a time, as
array operations over transition lists.

A language's sample is of whole documents, those whose ids hash lowest among
the documents of ``SAMPLE_CHARS`` code points or less: ``SAMPLE_DOCS`` at most
and as many as ``SAMPLE_CHARS`` code points hold; the shortest document where
all are longer. It does not depend on the other languages. Automata are built a
language a task. One holds its own letters and its transitions, sorted, at most
3 for each letter of the sample, so about 2 MB; a model of 200 languages about
400 MB with the driver and each task's worker. Prediction covers every text
whole.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text where nothing was learned; ties go to the language first
in order; rows with null or repeated ids are predicted one by one.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wapspark.llm import words as W
from wapspark.llm.pretokens import valid_chunk
from wapspark.operators.joins import bounded_broadcast
from wapspark.session import ensure_checkpoint_dir

UNKNOWN = "und"
SAMPLE_DOCS = 64
SAMPLE_CHARS = 1 << 16
RUN = 64

_folding: list[np.ndarray] = []


def folding() -> np.ndarray:
    """Lower-case letter of every code point, 0 for what is no letter."""
    if not _folding:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if unicodedata.category(c)[0] == "L":
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _folding.append(table)
    return _folding[0]


def letters(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of a chunk's texts (0 between words) and rows' bounds;
    the chunk must be valid UTF-8."""
    lead = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
    text = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return folding()[text], lead[chunk.offsets]


def words_of(folded: np.ndarray, bounds: np.ndarray):
    """Start, length and row of the runs of letters, long ones in pieces."""
    n = len(folded)
    inside = folded > 0
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    start = np.flatnonzero(inside & (cut[:n] | ~np.concatenate(([False], inside[:-1]))[:n]))
    end = np.flatnonzero(inside & (cut[1:] | ~np.concatenate((inside[1:], [False]))[:n])) + 1
    pieces = (end - start + RUN - 1) // RUN
    of = np.repeat(np.arange(len(start)), pieces)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = start[of] + RUN * nth
    return first, np.minimum(end[of] - first, RUN), np.searchsorted(bounds, first, side="right") - 1


@dataclass
class Automaton:
    """Transitions of a suffix automaton as lists sorted by state and letter.
    Letters are places in its own alphabet, ascending code points, 0 (the space
    before a word) first; what it lacks has the place after the last."""

    alphabet: np.ndarray  # code points, uint32
    key: np.ndarray       # state * (letters + 1) + letter, int64, ascending
    target: np.ndarray    # int32
    length: int           # of the sample

    def numbers(self, folded: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, folded)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == folded, at, len(self.alphabet))

    def move(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        want = state * (len(self.alphabet) + 1) + letter
        at = np.searchsorted(self.key, want)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == want, self.target[at], -1)


def build(text: np.ndarray) -> Automaton:
    """Suffix automaton of ``text`` (code points, 0 between words)."""
    alphabet, numbers = np.unique(np.append(text, 0).astype(np.uint32), return_inverse=True)
    link, size, moves = [-1], [0], [{}]
    last = 0
    for c in numbers[:-1].tolist():
        state = len(link)
        link.append(0)
        size.append(size[last] + 1)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if size[p] + 1 == size[q]:
                link[state] = q
            else:  # the longest of q's strings part from the rest
                copy = len(link)
                link.append(link[q])
                size.append(size[p] + 1)
                moves.append(dict(moves[q]))
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    count = np.fromiter(map(len, moves), np.int64, len(moves))
    total = int(count.sum())
    letter = np.fromiter((c for m in moves for c in m), np.int64, total)
    target = np.fromiter((t for m in moves for t in m.values()), np.int32, total)
    key = np.repeat(np.arange(len(moves)), count) * (len(alphabet) + 1) + letter
    order = np.argsort(key)
    return Automaton(alphabet, key[order], target[order], len(text))


@dataclass
class Model:
    languages: list[str]
    automata: list[Automaton]


def sample_letters(texts: list[str]) -> np.ndarray:
    """The words of sample texts, a space (0) before each."""
    parts = []
    for text in texts:
        chunk = next(W.text_chunks(pa.array([text], pa.large_string())))
        folded, bounds = letters(valid_chunk(chunk))
        start, size, _ = words_of(folded, bounds)
        out = np.zeros(int(size.sum()) + len(size), np.uint32)
        at = np.arange(len(out)) - np.repeat(np.arange(len(size)) + 1, size + 1)
        first = np.cumsum(size) - size
        word = np.repeat(np.arange(len(size)), size + 1)
        inside = at >= first[word]
        out[inside] = folded[(start[word] + at - first[word])[inside]]
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def learn(samples: dict[str, list[str]]) -> Model:
    """A model of sample texts by language."""
    text = {language: sample_letters(samples[language]) for language in sorted(samples)}
    text = {k: v for k, v in text.items() if len(v)}
    return Model(list(text), [build(v) for v in text.values()])


def phrases(model: Model, grid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Phrases of each word in each language. ``grid`` holds the words' letters
    (folded code points) in rows; a space goes before each."""
    out = np.zeros((len(model.automata), len(grid)), np.int64)
    for k, automaton in enumerate(model.automata):
        numbers = automaton.numbers(grid)
        space = int(automaton.move(np.zeros(1, np.int64), np.zeros(1, np.int64))[0])
        begin = automaton.move(np.zeros(len(automaton.alphabet) + 1, np.int64),
                               np.arange(len(automaton.alphabet) + 1))
        state = np.full(len(grid), max(space, 0), np.int64)
        count = np.zeros(len(grid), np.int64)
        for i in range(grid.shape[1]):
            live = np.flatnonzero(sizes > i)
            letter = numbers[live, i]
            ahead = automaton.move(state[live], letter)
            # The open phrase ends, if there is one, and the letter begins the
            # next; one that the language lacks is a phrase of its own.
            stuck = np.flatnonzero(ahead < 0)
            again = begin[letter[stuck]]
            count[live[stuck]] += (state[live[stuck]] > 0).astype(int) + (again < 0)
            ahead[stuck] = np.maximum(again, 0)
            state[live] = ahead
        # What is still open at a word's end is a phrase.
        out[k] = count + (state > 0)
    return out


def _predict(model: Model, chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Best language (-1: none) and score of the chunk's texts."""
    chunk = valid_chunk(chunk)
    folded, bounds = letters(chunk)
    start, size, row = words_of(folded, bounds)
    best, score = np.full(chunk.rows, -1), np.zeros(chunk.rows)
    if not len(start) or not model.languages:
        return best, score
    up = W.rolling(folded.astype(np.uint64), start, size)
    _, first, inverse = np.unique(up, return_index=True, return_inverse=True)
    counts = np.zeros((len(model.languages), len(first)), np.int64)
    order = np.argsort(size[first], kind="stable")
    for lo in range(0, len(order), 1 << 14):
        own = order[lo:lo + (1 << 14)]
        s, k = start[first[own]], size[first[own]]
        wide = np.minimum(s[:, None] + np.arange(k.max()), len(folded) - 1)
        counts[:, own] = phrases(model, folded[wide], k)
    norm = np.log(np.array([max(a.length, 2) for a in model.automata]))
    total = np.array([np.bincount(row, weights=c[inverse], minlength=chunk.rows) for c in counts])
    cost = total * norm[:, None]
    some = np.bincount(row, minlength=chunk.rows) > 0
    best[some] = cost.argmin(axis=0)[some]
    ranked = np.sort(cost, axis=0)
    second = ranked[1] if len(ranked) > 1 else 2 * ranked[0]
    score[some] = (1 - 0.5 * ranked[0] / np.maximum(second, 1e-9))[some]
    return best, np.clip(score, 0, 1)


_AUTOMATON = "lang string, alphabet binary, keys binary, targets binary, length long"


def _build_language(key, table):
    """One language's sample, in the order of its documents, as an automaton."""
    table = table.sort_by([("h", "ascending"), ("id", "ascending")])
    text = sample_letters(table.column("text").to_pylist())
    if not len(text):
        return pa.table({n: pa.array([], t) for n, t in (
            ("lang", pa.string()), ("alphabet", pa.binary()), ("keys", pa.binary()),
            ("targets", pa.binary()), ("length", pa.int64()))})
    a = build(text)
    return pa.table({"lang": [key[0].as_py()], "alphabet": pa.array([a.alphabet.tobytes()], pa.binary()),
                     "keys": pa.array([a.key.tobytes()], pa.binary()),
                     "targets": pa.array([a.target.tobytes()], pa.binary()), "length": [a.length]})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Learns from a bounded sample of each language of ``docs``."""
    ensure_checkpoint_dir(docs.sparkSession)
    named = docs.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"),
                        F.col(text_col).alias("text")).dropna()
    sizes = named.select("lang", "id", F.xxhash64("id").alias("h"), F.length("text").alias("size"))
    sizes = sizes.withColumn("long", F.greatest(F.col("size") - SAMPLE_CHARS, F.lit(0)))
    # Ids and sizes alone, and each task keeps its own first ones before the shuffle.
    first = Window.partitionBy("lang").orderBy("long", "h", "id", "size")
    chosen = sizes.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= SAMPLE_DOCS)
    upto = F.sum("size").over(Window.partitionBy("lang").orderBy("nth"))
    chosen = (chosen.withColumn("upto", upto).filter((F.col("upto") <= SAMPLE_CHARS) | (F.col("nth") == 1))
              .select("lang", "id", "h", "size").distinct().checkpoint())
    # SAMPLE_DOCS narrow rows a language; beyond the bound the join shuffles.
    sample = named.withColumn("size", F.length("text")).join(
        bounded_broadcast(chosen), ["lang", "id", "size"])
    sample = sample.groupBy("lang", "h", "id").agg(F.min("text").alias("text"))
    got = sample.groupBy("lang").applyInArrow(_build_language, _AUTOMATON).orderBy("lang").collect()
    return Model([r["lang"] for r in got], [Automaton(
        np.frombuffer(r["alphabet"], np.uint32), np.frombuffer(r["keys"], np.int64),
        np.frombuffer(r["targets"], np.int32), r["length"]) for r in got])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """The id, ``lang_pred`` and ``score`` of every row."""
    narrow = docs.select(id_col, text_col)
    schema = T.StructType([T.StructField(id_col, narrow.schema[id_col].dataType),
                           T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 2 MB a language

    @W.give_back
    def run(batches):
        names = np.array([*shared.value.languages, UNKNOWN], object)
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1)):
                best, score = _predict(shared.value, chunk)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows),
                     pa.array(names[best], pa.string()), pa.array(score)], names=schema.names)

    return narrow.mapInArrow(run, schema)
