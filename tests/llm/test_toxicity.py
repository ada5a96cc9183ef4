import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from wapspark.llm import toxicity as X
from wapspark.llm import words as W
from llm_fixtures import docs  # noqa: F401


def test_sentences_of_a_text():
    text = "One two. (Three) four\nfive!\n\n  six?? seven"
    chunk = next(W.text_chunks(pa.array(["", None, text, "Three."])))
    words, sentence, row, start, end = X.sentences(chunk)
    assert [text.encode()[s:e].decode() for s, e in zip(start[:5], end[:5])] == [
        "One two.", "(Three) four", "five!", "six??", "seven"]
    assert row.tolist() == [2, 2, 2, 2, 2, 3]
    assert words[2] == words[7] and sentence.tolist() == [0, 0, 1, 1, 2, 3, 4, 5, 1, 4, 5]


def test_noisy_or_is_one_minus_the_product():
    scores, row = np.array([.5, .2, .9]), np.array([0, 0, 2])
    assert X.noisy_or(scores, row, 4) == pytest.approx([1 - .5 * .8, 0, .9, 0])


def made(n, seed):
    rng = random.Random(seed)
    plain, bad = [f"w{i}" for i in range(300)], ["vile", "rotten"]
    rows = []
    for i in range(n):
        toxic = rng.random() < .3
        sent = [rng.choices(plain, k=rng.randrange(3, 12)) for _ in range(rng.randrange(1, 20))]
        if toxic:
            rng.choice(sent).append(rng.choice(bad))
        rows.append((i, " ".join(" ".join(s).capitalize() + "." for s in sent), int(toxic)))
    return rows


def test_learns_from_document_labels_and_finds_the_sentence(spark):
    rows = made(900, 1)
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = X.fit(frame, frame.filter("doc_id < 600"))
    got = {r.doc_id: r for r in X.score(frame, model).collect()}
    held = [r for r in rows if r[0] >= 600]
    assert sum(got[i].predicted == y for i, _, y in held) >= .98 * len(held)
    for i, text, y in held:
        if y and got[i].predicted:
            said = [text[o.start:o.end].lower() for o in got[i].offending]
            assert said and all(any(b in x for b in ("vile", "rotten")) for x in said)


def test_scores_and_places_against_sentence_by_sentence(spark, docs):
    """Each sentence's words looked up one by one, products taken plainly."""
    train = spark.createDataFrame(made(400, 4), "doc_id long, text string, toxic int")
    model = X.fit(train, train)
    weight = dict(zip(model.words.tolist(), model.weights.tolist()))

    def plain(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        cleared, out = 1.0, []
        for line in re.finditer(r"[^\n]+", low):
            for m in re.finditer(r"[^ ](?:[^\n]*?[.!?](?= |$)|[^\n]*[^ ])", line[0]):
                words = [w.strip(".!?,()") for w in m[0].split()]
                words = {*words, *["~" + w.encode()[:X.STEM].decode() for w in words if len(w.encode()) > X.STEM]}
                logit = model.bias + sum(weight.get(hashed(w), 0.0) for w in words)
                p = 1 / (1 + math.exp(-logit))
                cleared *= 1 - p
                if p >= 0.5:
                    out.append((line.start() + m.start(), line.start() + m.end(), round(p, 9)))
        return 1 - cleared, out

    def hashed(w):
        chunk = next(W.text_chunks(pa.array([w.lstrip("~")])))
        h = W.span_hashes(chunk, np.array([0]), np.array([len(chunk.data)]), lower=True)
        return int((~h if w.startswith("~") else h)[0])

    rows = [(i, t) for i, t, _ in made(120, 6)]
    rows += [(500, "É vile w1. ü rotten!\nw2 VILE? w3"), (501, "(vile) é.\nno. Rotten, w5 (w6)")]
    hits = 0
    for r in X.score(docs(rows), model).collect():
        want, places = plain(dict(rows)[r.doc_id])
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == int(want >= 0.5)
        assert [(o.start, o.end, round(o.score, 9)) for o in r.offending] == places
        hits += len(places)
    assert hits > 30


def test_whole_texts_are_trained_on(spark):
    """What offends stands behind 100,000 characters of every toxic text."""
    long = "w1 w2 w3. " * 10000
    rows = [(i, long + (f"w4 vile w{i % 7}." if i % 2 else f"w4 w{i % 7}."), i % 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = X.fit(frame, frame)
    assert [r.predicted for r in X.score(frame, model).orderBy("doc_id").collect()] == [
        y for _, _, y in rows]


def test_sample_is_bounded_by_whole_documents(spark, monkeypatch):
    rows = made(300, 8)
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    monkeypatch.setattr(X, "SAMPLE_BYTES", 1)  # the first document of each label
    model = X.fit(frame, frame)
    assert len(model.words) == 0 and model.bias == -50.0


def test_odd_rows(docs, spark):
    train = spark.createDataFrame(made(400, 2), "doc_id long, text string, toxic int")
    model = X.fit(train, train.union(train).union(spark.createDataFrame([(None, None, 1)], train.schema)))
    rows = [(1, None), (2, ""), (3, " \n. !"), (None, "vile w1."), (None, "vile w1."),
            (5, "w1 w2. " * 30000 + "rotten")]
    d = docs(rows)
    got = {r.doc_id: (round(r.score, 3), r.predicted) for r in X.score(d, model).collect()}
    assert got[1] == got[2] == (0.0, 0) and got[None][1] == 1 and got[5][1] == 1
    assert X.keep(d, model).columns == d.columns
    assert sorted(r.doc_id for r in X.keep(d, model).collect()) == [1, 2, 3]
    assert X.score(docs([]), model).count() == 0


def test_without_training_rows_nothing_is_toxic(docs, spark):
    for rows in ([], [(1, "a b", 1)], [(1, None, 1), (2, "x", None), (3, "y", 7)]):
        train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = X.fit(train, train)
        assert [r.predicted for r in X.score(docs([(1, "a b c")]), model).collect()] == [0]


def test_held_out_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    held = lab.filter("crc32(cast(doc_id as string)) % 5 = 0")
    model = X.fit(d, lab.filter("crc32(cast(doc_id as string)) % 5 <> 0"))
    got = X.score(d, model).join(held, "doc_id").collect()
    wrong = sum(r.predicted != r.toxic for r in got)
    assert wrong <= .05 * len(got), (wrong, len(got))
    assert sum(r.predicted > r.toxic for r in got) <= .01 * len(got)
