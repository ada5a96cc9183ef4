import numpy as np

from test_neighbours import brute, frame, listed
from wapspark.llm import neighbours as N


def test_groups_are_bounded_in_queries_and_candidates(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 100)
    monkeypatch.setattr(N, "QUERY_BLOCK", 50, raising=False)
    score = N._score

    def watched(dim, k):
        run = score(dim, k)

        def bounded(key, queries, candidates):
            if queries.num_rows > 100 or candidates.num_rows > 200:
                raise ValueError(f"{queries.num_rows} queries, {candidates.num_rows} candidates")
            return run(key, queries, candidates)
        return bounded

    monkeypatch.setattr(N, "_score", watched)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-9, 10, 6)]) for i in range(900)]
    got = listed(N.search(frame(spark, rows), "id % 2 = 0", 20))
    want = brute(rows, 20, 2)
    assert got.keys() == want.keys()
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
