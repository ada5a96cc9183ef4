import math

import numpy as np

from wapspark.llm import neighbours as N


def brute(rows, k, every):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for q, v in good:
        if q % every == 0:
            best = sorted({(-float(v @ w), i) for i, w in good if i != q})[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        own = out.setdefault(r.query_id, [])
        assert r["rank"] == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, vec string")


def test_small_tables_are_exact_with_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, -1.0, 2.0, 1.0]) for i in range(200)]
    rows += [(2000, None), (2005, []), (2010, [0.0] * 6), (2015, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (2020, [float("nan")] * 6), (2025, [float("inf")] * 6), (None, [1.0] * 6), rows[5], rows[5]]
    got = listed(N.search(frame(spark, rows), "id % 5 = 0", 20))
    want = brute(rows, 20, 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_few_and_no_rows(spark):
    assert listed(N.search(frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 0.0]), (2, [1.0])]),
                           "id % 20 = 0")) == {0: [(1, 2.0)]}
    assert N.search(frame(spark, []), "id % 20 = 0").count() == 0
    assert N.search(frame(spark, [(0, [0.0])]), "id % 20 = 0").count() == 0


def test_recall_over_learned_parts(spark, monkeypatch):
    monkeypatch.setattr(N, "PART", 200)
    monkeypatch.setattr(N, "BLOCK", 64)
    rows = [(r.vec_id, list(r.embedding)) for r in
            spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = listed(N.search(frame(spark, rows), "id % 20 = 0"))
    want = brute(rows, 20, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= .9 * sum(map(len, want.values()))
    assert all(len(got[q]) == 20 for q in want)


def test_visits_are_set_on_vectors_left_out(monkeypatch):
    """With 256 parts, on clustered vectors: few parts are visited and what was
    promised on vectors left out holds for others."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(300, 24))
    draw = lambda n: centres[rng.integers(300, size=n)] + 0.25 * rng.normal(size=(n, 24))
    seen = []
    graph = N.cut_graph
    monkeypatch.setattr(N, "cut_graph", lambda v, *a: (seen.append(len(v)), graph(v, *a))[1])
    sample = draw(4096)
    router = N.learn(sample, 256, 20)
    assert seen == [4096 - 512] and router.visits < 128
    stored, asked = draw(20000), draw(300)
    place = router.scores(stored).argmax(axis=1)
    visited = np.argsort(-router.scores(asked), axis=1)[:, :router.visits + 1]
    truth = N.nearest(asked, stored, 20)
    hits = (place[truth][:, :, None] == visited[:, None, :]).any(axis=2)
    assert hits.mean() >= 0.9


def test_small_tables_use_parts_too(spark, monkeypatch):
    learned = []
    fit = N._fit
    monkeypatch.setattr(N, "_fit", lambda parts, *a: (learned.append(parts), fit(parts, *a))[1])
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(120)]
    got = listed(N.search(frame(spark, rows), "id % 20 = 0"))
    assert learned == [2]
    want = brute(rows, 20, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
