import math
import unicodedata

import numpy as np
import pyarrow as pa

from wapspark.llm import language_id as L
from wapspark.llm import words as W
from llm_fixtures import docs  # noqa: F401


def fold(c):
    low = c.lower()
    return low if len(low) == 1 else c


def words(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if unicodedata.category(c)[0] == "L":
            run += fold(c)
        elif run:
            out += [run[i:i + 64] for i in range(0, len(run), 64)]
            run = ""
    return out


def parse(sample, text):
    """Phrases by searching the sample for the longest piece each time."""
    total = 0
    for word in words(text):
        left = " " + word if " " in sample else word
        while left:
            k = 1
            while k < len(left) and left[:k + 1] in sample:
                k += 1
            total += 1
            left = left[k:]
    return total


SAMPLES = {"a": ["The cat sat on the mat. Other cats there."], "b": ["Der Hund läuft über die Straße."],
           "c": ["El perro corre por la calle, señor"]}
TEXTS = ["the cat", "über den Hund", "perro señor", "", None, "123 !?", "Ж", "THE STRASSE läuft",
         "x" * 300, "cat " * 2000, "ß", "no 1 word2word"]


def test_counts_equal_searching():
    model = L.learn(SAMPLES)
    samples = {k: "".join(" " + w for w in words(v[0])) for k, v in SAMPLES.items()}
    for chunk in W.text_chunks(pa.array(TEXTS), 50):
        best, score = L._predict(model, chunk)
        for r in range(chunk.rows):
            text = TEXTS[chunk.first + r]
            if not words(text):
                assert best[r] == -1 and score[r] == 0
                continue
            cost = [parse(s, text) * math.log(len(s)) for s in samples.values()]
            assert best[r] == int(np.argmin(cost)), text[:40]
            assert 0 <= score[r] <= 1


def test_odd_rows_and_no_training(docs):
    model = L.learn(SAMPLES)
    rows = [(None, "the cat"), (None, "the cat"), (1, None), (2, " 12 "), (3, "Hund")]
    got = sorted(((r.doc_id, r.lang_pred) for r in L.predict(docs(rows), model).collect()), key=str)
    assert got == sorted([(None, "a"), (None, "a"), (1, "und"), (2, "und"), (3, "b")], key=str)
    nothing = L.fit(docs([]))
    assert [r.lang_pred for r in L.predict(docs([(1, "the")]), nothing).collect()] == ["und"]
    assert L.predict(docs([]), model).count() == 0
    blank = L.fit(docs([(1, "1 2"), (2, None)]))
    assert [r.lang_pred for r in L.predict(docs([(1, "the")]), blank).collect()] == ["und"]


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = "crc32(cast(doc_id as string)) % 3 = 1"
    model = L.fit(d.filter(f"not {held}"))
    assert model.languages == ["de", "en", "es", "fr"]
    got = L.predict(d, model).join(d.filter(held).select("doc_id", "lang"), "doc_id").collect()
    right = sum(r.lang_pred == r.lang for r in got)
    assert right >= .97 * len(got), (right, len(got))


def test_ideographs_need_little_memory(docs, spark):
    """Thousands of letters: transitions are lists, not tables over all letters."""
    rng = np.random.default_rng(3)
    blocks = {"zh": (0x4E00, 3000), "ko": (0xAC00, 4000), "ja": (0x6000, 3000)}
    rows = [(f"{k}{i}", "".join(chr(lo + int(x)) for x in rng.integers(0, n, 900)), k)
            for k, (lo, n) in blocks.items() for i in range(60)]
    rows += [(f"en{i}", "the cat sat on a mat " * 40, "en") for i in range(60)]
    frame = spark.createDataFrame([(x, t, k) for x, t, k in rows], "doc_id string, text string, lang string")
    model = L.fit(frame)
    size = sum(a.key.nbytes + a.target.nbytes + a.alphabet.nbytes for a in model.automata)
    assert model.languages == ["en", "ja", "ko", "zh"] and size < 16 << 20
    got = L.predict(frame, model).join(frame, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= .95 * len(got)


def test_a_language_learns_the_same_beside_others(docs, spark):
    rows = [(f"{k}{i}", f"{k * 3} {k}x{chr(97 + i % 20)} word", k) for k in "abcdefgh" for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    alone, beside = L.fit(frame.filter("lang = 'c'")), L.fit(frame)
    own = beside.automata[beside.languages.index("c")]
    assert np.array_equal(alone.automata[0].key, own.key) and alone.automata[0].length == own.length


def test_whole_documents_are_sampled(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE_CHARS", 100)
    rows = [("1", "aaa " * 20 + "last", "x"), ("2", "bbb " * 50, "x"), ("3", "ccc " * 60, "y"),
            ("4", "ddd " * 40, "y")]
    frame = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    model = L.fit(frame)  # 84 letters; only longer ones, of which the shortest
    seen = {k: {chr(c) for c in a.alphabet if c} for k, a in zip(model.languages, model.automata)}
    assert seen == {"x": set("alst"), "y": set("d")}


def test_ties_go_to_the_first_language():
    model = L.learn({"b": ["same words"], "a": ["same words"], "c": ["other"]})
    best, score = L._predict(model, next(W.text_chunks(pa.array(["same words"]))))
    assert model.languages[best[0]] == "a" and score[0] == 0.5
