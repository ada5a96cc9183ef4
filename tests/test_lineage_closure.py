"""O7 over all hops, cycles and joins of paths included."""

import random

from wapspark.operators import observability
from wapspark.operators.joins import materialize
from wapspark.operators.observability import lineage_closure


def brute(edges, most=None):
    out = {}
    nodes = {a for a, _ in edges}
    for n in nodes:
        seen, front, hops = {}, {n}, 0
        while front and (most is None or hops < most):
            hops += 1
            front = {b for a, b in edges if a in front} - set(seen)
            seen |= {b: hops for b in front}
        out |= {(n, b): h for b, h in seen.items()}
    return out


def test_random_graphs(spark):
    rng = random.Random(2)
    for n, m in ((6, 9), (14, 16), (20, 45)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        df = spark.createDataFrame(edges + edges[:3] + [(None, 1), (1, None)], "source_id int, target_id int")
        for most in (None, 3):
            got = {(r.node, r.reaches): r.hops for r in lineage_closure(df, max_hops=most).collect()}
            assert got == brute(set(edges), most)


def test_chain_needs_few_rounds_and_ends_are_right(spark):
    chain = [(i, i + 1) for i in range(40)]
    df = spark.createDataFrame(chain, "source_id int, target_id int")
    got = {(r.node, r.reaches): r.hops for r in lineage_closure(df).collect()}
    assert got == {(a, b): b - a for a in range(40) for b in range(a + 1, 41)}
    assert lineage_closure(df.limit(0)).count() == 0 and lineage_closure(df, max_hops=0).count() == 0


def test_each_pair_is_found_and_written_once(spark, monkeypatch):
    written = []

    def counted(df, name):
        out = materialize(df, name)
        written.append(out.count())
        return out
    monkeypatch.setattr(observability, "materialize", counted)
    ring = [(i, (i + 1) % 21) for i in range(21)]
    df = spark.createDataFrame(ring, "source_id int, target_id int")
    assert lineage_closure(df).count() == 21 * 21
    assert sum(written) == 21 * 21 and written[:4] == [21, 21, 42, 84]
