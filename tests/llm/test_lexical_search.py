import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from llm_fixtures import docs  # noqa: F401
from wapspark.llm import lexical_search as L
from wapspark.llm.registry import ORACLE_SQL, op12_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(rows, items, k=20):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    held = [h for h in held if h[2]]
    n, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, size in held:
            m = 75 + (25 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i, score))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, x[2], x[3]) for r, x in enumerate(scored[:k])]
    return sorted(out, key=str)


def told(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def asked(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score long")


def made(seed, docs_n, items_n, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"é{i}Ü" for i in range(vocabulary)]
    draw = lambda n: " ".join(words[min(int(rng.expovariate(0.08)), vocabulary - 1)]
                              for _ in range(n))
    return ([(i, draw(rng.randrange(1, 60))) for i in range(docs_n)],
            [(i, draw(rng.randrange(1, 100))) for i in range(items_n)])


def test_whole_table_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["op12_lexical_search"]).fetchall()
    got = told(op12_lexical_search(spark, sf))
    assert got == sorted(want, key=str) and len(got) == 800


def test_small_blocks_against_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_DOCS", 16)
    monkeypatch.setattr(L, "CELLS", 256)
    monkeypatch.setattr(L, "ITEM_BYTES", 900)
    monkeypatch.setattr(L, "TEXT_BYTES", 800)
    rows, items = made(3, 300, 12)
    assert told(L.search(docs(rows), asked(spark, items), k=7)) == brute(rows, items, 7)


def test_masks_are_left_out_only_when_they_cannot_reach(monkeypatch):
    rng = np.random.default_rng(4)
    scored = 0
    for _ in range(40):
        t, n = int(rng.integers(1, 90)), 500
        tf = rng.integers(1, 5, (t, n)) * (rng.random((t, n)) < rng.random((t, 1)) ** 3)
        weight = rng.integers(1, 9000, t)
        m, ids = rng.integers(75, 300, n), rng.permutation(n)
        best = L.Best(5)
        scored += L.search_block(tf, weight, m, ids, ids >= 0, best)
        score = (weight[:, None] * np.where(tf > 0, L._points(tf, m[None, :]), 0)).sum(axis=0)
        want = sorted(((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if s > 0))[:5]
        assert [(-s, i) for s, i in zip(best.score.tolist(), best.id.tolist())] == want
    assert scored < 40 * 500 * 0.6


def test_ties_nulls_blanks_repeats_and_long_texts(spark, docs):
    rows = [(i, "same words here") for i in range(40)] + [(None, "same words here")] * 2
    rows += [(7, "same words here"), (100, None), (101, ""), (102, " ,;\n"), (103, "ROT-rot_Rot"),
             (104, "Ärger ärger"), (105, "x " * 30000 + "rot here")]
    items = [(1, "here"), (1, "here"), (2, "rot ROT"), (None, "ärger"), (3, None), (4, ""), (5, "-,;"),
             (6, "unheard"), (7, "x rot " * 3000)]
    got = told(L.search(docs(rows), asked(spark, items)))
    assert got == brute(rows, [i for i in items if i[1]])
    assert [r[2] for r in sorted(got, key=lambda r: str(r[:1]) + f"{r[1]:3}") if r[0] == 1][:5] == [0, 1, 2, 3, 4]
    few = rows[38:43]
    assert told(L.search(docs(few), asked(spark, items))) == brute(few, [i for i in items if i[1]])
    assert L.search(docs(rows[:0]), asked(spark, items)).count() == 0
    assert L.search(docs(rows), asked(spark, items[:0])).count() == 0
    assert L.search(docs([(1, None)]), asked(spark, items)).count() == 0
