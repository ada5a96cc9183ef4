import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from llm_fixtures import docs  # noqa: F401
from wapspark.llm import periodic_runs as P
from wapspark.llm import words as W
from wapspark.llm.registry import op11_periodic_runs


def brute(words, least=24):
    """All runs (start, length, period), by comparing every word with that q later."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            size = e - s + q
            if size >= max(least, 3 * q):
                own = words[s:s + size]
                if not any(all(own[i] == own[i + d] for i in range(size - d)) for d in range(1, q)):
                    found.append((s, size, q))
            s = e + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def answer(doc_id, words):
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def told(df):
    return sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli,
                    r.runs_sha256, r.collapsed_sha256) for r in df.collect()), key=str)


def shapes():
    rng = random.Random(5)
    text = [["a"] * n for n in (1, 23, 24, 25, 200)]
    for n in (60, 150, 400):
        text += [[rng.choice("ab") for _ in range(n)] for _ in range(4)]
    for q in (1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100):
        unit = [f"w{i}" for i in range(q)]
        for extra in (-1, 0, 1, 5):
            size = max(24, 3 * q) + extra
            run = (unit * (size // q + 2))[:size]
            text.append([f"x{i}" for i in range(rng.randrange(40))] + run + ["y", "z"])
    fib, old = ["b"], ["a"]
    while len(fib) < 500:
        fib, old = fib + old, fib
    morse = [0]
    while len(morse) < 4096:
        morse += [1 - x for x in morse]
    nested = (["a"] * 30 + ["b"]) * 5
    return [*text, fib, ["ab"[x] for x in morse[:700]], nested, nested + nested[:40] + ["c"] * 26]


def test_fragments_stitch_to_all_runs(spark, docs):
    rows = [(i, " ".join(words)) for i, words in enumerate(shapes())]
    got = {r.doc_id: [(x.start, x.length, x.period) for x in r.runs]
           for r in P.runs(docs(rows)).collect()}
    assert got == {i: brute(words) for i, words in enumerate(shapes())}


@pytest.mark.parametrize("least", [1, 3, 6, 12, 30, 50])
def test_other_least_lengths(least):
    rng = np.random.default_rng(least)
    for n in (5, 40, 200):
        for letters in (1, 2, 3):
            words = rng.integers(0, letters, n)
            bounds = np.array([0, n])
            text, q, s, e = P.fragments(W.mix(words.astype(np.uint64) + np.uint64(7)), bounds, least)
            whole = {}
            for x in sorted(zip(q.tolist(), s.tolist(), e.tolist())):
                own = whole.setdefault(x[0], [])
                if own and own[-1][1] - x[1] >= x[0]:
                    own[-1][1] = max(own[-1][1], x[2])
                else:
                    own.append([x[1], x[2]])
            got = sorted((s, e - s, q) for q, own in whole.items() for s, e in own
                         if e - s >= max(least, 3 * q))
            assert got == sorted(brute(words.tolist(), least))


def test_equal_opposites_are_not_taken_as_equal():
    """Blocks that a polynomial hash modulo 2**64 can't tell apart."""
    morse = np.zeros(1, np.int64)
    while len(morse) < 1 << 13:
        morse = np.concatenate((morse, 1 - morse))
    text, q, s, e = P.fragments(W.mix(morse.astype(np.uint64) + np.uint64(3)),
                                np.array([0, len(morse)]), 24)
    assert not np.any(e - s >= np.maximum(24, 3 * q))


def test_query_against_brute_force_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 6000]
    got = {x[0]: x for x in told(op11_periodic_runs(spark, sf))}
    assert len(got) == len(rows)
    for r in short:
        assert got[r.doc_id] == answer(r.doc_id, planted(r.doc_id, r.text))


def test_planting(spark, docs):
    text = "  Az bé\tc d e f\n g h i j k l m n o p q r s t u v w x y z " * 3
    rows = [(i, text) for i in range(200)] + [(None, text), (201, None), (202, ""), (203, " \n ")]
    got = {r.doc_id: r.text for r in P.planted(docs(rows)).collect()}
    for i, t in rows:
        assert re.findall(r"[^\x20\x09-\x0D]+", got[i] or "") == planted(i, t)


def test_nulls_blanks_repeats_and_long_texts(spark, docs):
    loop = "x " + "a b c " * 20
    # no id among these is planted
    rows = [(None, loop), (None, loop), (None, None), (3, None), (4, ""), (5, " \t\n"),
            (6, loop), (6, loop), (6, loop + "d"), (7, "a b " * 30), (7, "Ab aB " * 12),
            (8, " ".join(f"w{i % 5000}" for i in range(60000)) + " tail")]
    got = told(P.digest(P.runs(docs(rows))))
    want = [answer(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows[:-1]]
    words = rows[-1][1].split(" ")
    want.append((8, 1, 0, 60000, 5000, 12000,
                 hashlib.sha256(b"0,60000,5000\n").hexdigest(),
                 hashlib.sha256(" ".join(words[:5000] + words[-1:]).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert P.digest(P.runs(docs(rows[:0]))).count() == 0
