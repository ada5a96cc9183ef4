"""Toxicity by multiple-instance learning (operator 4).

A document is a bag of sentences. A sentence's score is a logistic function of
its distinct words and their stems, and a document's is the noisy-or of its sentences': it is
toxic if at least one of them is. Only documents carry labels; the weights are
trained through the noisy-or, and then name the sentences that offend.

Training takes a bounded sample of labelled documents in one task, whole texts:
of each label those whose ids hash lowest, ``SAMPLE_DOCS`` at most and as many
as ``SAMPLE_BYTES`` hold (the first one in any case). Scoring covers every
document. The model is a table of at most ``VOCABULARY`` word hashes with
weights, small enough to go along with the tasks.

Defined results: a null or empty text, or one without words, has no sentence
and scores the noisy-or of nothing, 0; without training rows of both labels
every score is 0; labels other than 0 and 1, or null, are not trained on; rows
with null or repeated ids are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wapspark.llm import words as W
from wapspark.session import ensure_checkpoint_dir

SAMPLE_DOCS = 3000
SAMPLE_BYTES = 1 << 23
VOCABULARY = 1 << 15
LEAST_DOCS = 5      # documents of the sample that a word must stand in
STEM = 4
STEPS = 300

_STOP = np.zeros(256, bool)
_STOP[list(b"\n.!?")] = True
# ASCII marks around a word that are not part of it.
_MARK = np.zeros(256, bool)
_MARK[list(b"\"'`()[]{}<>.,;:!?*_-#|&%$~=+/\\")] = True


@dataclass
class Model:
    words: np.ndarray    # uint64, ascending
    weights: np.ndarray  # float64
    bias: float

    @staticmethod
    def empty() -> "Model":
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)


def sentences(chunk: W.Chunk):
    """Hash and sentence of every word and of the first ``STEM`` bytes of every
    longer one; row, start and end of every sentence.

    A sentence ends after a newline or a word that ends in . ! or ?; ASCII
    marks at a word's ends are cut off, and A-Z are folded."""
    w = W.words(chunk)
    n = len(w.start)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    newlines = np.concatenate(([0], np.cumsum(chunk.data == 10)))
    ends = _STOP[chunk.data[w.end - 1]]
    first = np.ones(n, bool)
    first[1:] = ends[:-1] | (w.row[1:] != w.row[:-1]) | (
        newlines[w.start[1:]] != newlines[w.start[:-1]])
    at = np.flatnonzero(first)
    sentence = np.cumsum(first) - 1
    start, end = w.start.copy(), w.end.copy()
    for _ in range(3):
        start += (start < end) & _MARK[chunk.data[np.minimum(start, len(chunk.data) - 1)]]
        end -= (start < end) & _MARK[chunk.data[np.maximum(end - 1, 0)]]
    last = np.append(at[1:], n) - 1
    long = np.flatnonzero(end - start > STEM)
    words = np.concatenate((W.span_hashes(chunk, start, end, lower=True), ~W.span_hashes(
        chunk, start[long], start[long] + STEM, lower=True)))
    return (words, np.concatenate((sentence, sentence[long])), w.row[at], w.start[at], w.end[last])


def _distinct(words: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word once a sentence."""
    order = np.lexsort((words, sentence))
    words, sentence = words[order], sentence[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (sentence[1:] != sentence[:-1])
    return words[new], sentence[new]


def _known(model: Model, words: np.ndarray, sentence: np.ndarray):
    """Places in the model and sentences of the words it knows."""
    at = np.searchsorted(model.words, words)
    at[at == len(model.words)] = 0
    hit = model.words[at] == words if len(model.words) else np.zeros(len(words), bool)
    return at[hit], sentence[hit]


def sentence_scores(model: Model, words: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    words, sentence = _distinct(*[x for x in (words, sentence)])
    at, of = _known(model, words, sentence)
    logit = model.bias + np.bincount(of, weights=model.weights[at], minlength=n)
    return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def noisy_or(scores: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return -np.expm1(np.bincount(row, weights=np.log1p(-np.minimum(scores, 1 - 1e-12)),
                                 minlength=rows))


def train(texts: pa.Array, labels: np.ndarray) -> Model:
    """Weights by gradient descent on the documents' log-loss, with a pull of
    each weight to 0. Features are words of several sample documents."""
    labels = np.asarray(labels)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model.empty()
    parts, n_sent = [], 0
    for chunk in W.text_chunks(texts):
        words, sentence, row, _, _ = sentences(chunk)
        words, sentence = _distinct(words, sentence)
        # In how many documents each word of the chunk is.
        found = np.unique(_distinct(words, row[sentence])[0], return_counts=True)
        parts.append((words, (sentence + n_sent).astype(np.int32), row + chunk.first, found))
        n_sent += len(row)
    vocabulary, at = np.unique(np.concatenate([p[3][0] for p in parts]), return_inverse=True)
    df = np.bincount(at, weights=np.concatenate([p[3][1] for p in parts]), minlength=len(vocabulary))
    row = np.concatenate([p[2] for p in parts])
    often = np.flatnonzero(df >= LEAST_DOCS)
    often = np.sort(often[np.argsort(-df[often], kind="stable")[:VOCABULARY]])
    if not len(often):
        return Model.empty()
    model = Model(vocabulary[often], np.zeros(len(often)), -5.0)
    # Chunk by chunk: only what the model knows is held from here on.
    known = [_known(model, p[0], p[1]) for p in parts]
    del parts
    at = np.concatenate([k[0] for k in known]).astype(np.int32)
    of = np.concatenate([k[1] for k in known])
    del known
    order = np.argsort(at, kind="stable")
    of_by_word, word_ends = of[order], np.searchsorted(at[order], np.arange(len(often) + 1))
    y = labels.astype(float)
    n, m1, m2 = len(y), np.zeros(len(often) + 1), np.zeros(len(often) + 1)
    for step in range(1, STEPS + 1):
        logit = model.bias + np.bincount(of, weights=model.weights[at], minlength=n_sent)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        miss = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n)
        doc = np.clip(-np.expm1(miss), 1e-9, 1 - 1e-9)
        # d loss / d logit of a sentence: p (1 - y / doc), by the chain rule.
        slope = p * (1 - y / doc)[row]
        sums = np.concatenate(([0], np.cumsum(slope[of_by_word])))
        gradient = np.append(sums[word_ends[1:]] - sums[word_ends[:-1]] + 0.1 * model.weights,
                             slope.sum())
        gradient /= n
        m1 = 0.9 * m1 + 0.1 * gradient
        m2 = 0.99 * m2 + 0.01 * gradient ** 2
        move = 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= move[-1]
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Trains on a bounded sample of the ids in ``labels``, the same at every
    run; only their texts leave ``docs``."""
    ensure_checkpoint_dir(docs.sparkSession)
    ids = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        "id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    ids = ids.withColumn("h", F.xxhash64("id"))
    chosen = ids.filter("y = 0").orderBy("h", "id").limit(SAMPLE_DOCS).union(
        ids.filter("y = 1").orderBy("h", "id").limit(SAMPLE_DOCS))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = (texts.join(F.broadcast(chosen), "id").filter("text is not null")  # bounded rows
             .groupBy("id", "y", "h").agg(F.min("text").alias("text")).checkpoint())
    # Sizes alone in the window; a document is taken whole or not at all.
    upto = Window.partitionBy("y").orderBy("h", "id")
    fits = (texts.select("id", "y", "h", F.octet_length("text").alias("size"))
            .withColumn("upto", F.sum("size").over(upto))
            .filter((F.col("upto") <= SAMPLE_BYTES) | (F.col("upto") == F.col("size"))))
    sample = texts.join(F.broadcast(fits.select("id")), "id").select("text", "y", "h")

    @W.give_back
    def run(batches):
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None:
            return
        table = table.sort_by([("h", "ascending"), ("y", "ascending"), ("text", "ascending")])
        model = train(table.column("text"), table.column("y").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.words.tobytes()]), pa.array([model.weights.tobytes()]),
             pa.array([float(model.bias)])], names=["words", "weights", "bias"])

    got = sample.coalesce(1).mapInArrow(run, "words binary, weights binary, bias double").collect()
    if not got:
        return Model.empty()
    return Model(np.frombuffer(bytes(got[0][0]), np.uint64), np.frombuffer(bytes(got[0][1])),
                 got[0][2])


def _chunk_scores(model: Model, chunk: W.Chunk) -> np.ndarray:
    words, sentence, row, _, _ = sentences(chunk)
    return noisy_or(sentence_scores(model, words, sentence, len(row)), row, chunk.rows)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The id, ``score`` and ``predicted`` (1 from 0.5 on) of every row, and
    ``offending``: its sentences that score 0.5 or more, by place, with start
    and end (exclusive, code points) and their own score."""
    narrow = docs.select(id_col, text_col)
    schema = T.StructType([T.StructField(id_col, narrow.schema[id_col].dataType),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("offending", T.ArrayType(T.StructType([
                               T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                               T.StructField("score", T.DoubleType())])))])
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    @W.give_back
    def run(batches):
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1)):
                words, sentence, row, start, end = sentences(chunk)
                each = sentence_scores(model, words, sentence, len(row))
                got = noisy_or(each, row, chunk.rows)
                point = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
                bad = np.flatnonzero(each >= 0.5)
                first = point[chunk.offsets[row[bad]]]
                per_row = np.searchsorted(row[bad], np.arange(chunk.rows + 1))
                found = pa.StructArray.from_arrays(
                    [pa.array(point[start[bad]] - first), pa.array(point[end[bad]] - first),
                     pa.array(each[bad])], fields=list(kind))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), pa.array(got),
                     pa.array((got >= 0.5).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), found)],
                    names=schema.names)

    return narrow.mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns."""
    at = docs.columns.index(text_col)

    @W.give_back
    def run(batches):
        for batch in batches:
            for chunk in W.text_chunks(batch.column(at)):
                yield batch.slice(chunk.first, chunk.rows).filter(
                    pa.array(_chunk_scores(model, chunk) < 0.5))

    return docs.mapInArrow(run, docs.schema)
