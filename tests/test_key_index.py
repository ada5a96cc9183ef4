"""A11 / J6 by a stored Bloom filter: exact whatever the filter says, cold buckets unread."""

import re

from pyspark.sql import functions as F

from wapspark.operators import publish
from wapspark.operators.key_index import KeyIndex, insert_if_absent_indexed
from wapspark.sources.sinks import read_if_present


def made(spark, tmp_path, keys, expected=None, buckets=8, name="ix"):
    index = KeyIndex.create(spark, str(tmp_path / name), ["k"], expected or max(1, len(keys)), buckets)
    if keys:
        index.add(frame(spark, keys), "r0")
        index.commit("r0")
    return index


def frame(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")


def keys_of(df):
    return sorted(r.k for r in df.collect())


def test_known_keys_are_found_and_few_others_looked_up(spark, tmp_path):
    index = made(spark, tmp_path, [f"a{i}" for i in range(4000)])
    index.add(frame(spark, [f"b{i}" for i in range(50)]), "r1")
    index.commit("r1")
    asked = frame(spark, [f"a{i}" for i in range(0, 4000, 400)] + ["b7", None]
                  + [f"c{i}" for i in range(4000)])
    want = sorted([f"a{i}" for i in range(0, 4000, 400)] + ["b7"])
    maybe = keys_of(index.maybe(asked))
    assert set(want) <= set(maybe) and len(maybe) - len(want) <= 4000 * 0.004
    assert keys_of(index.known(asked)) == want
    assert index.absent(asked).count() == 4001
    assert 0.3 < index.load() < 0.5


def test_false_positives_never_cost_a_row(spark, tmp_path):
    """A filter far too small says maybe to everything."""
    index = made(spark, tmp_path, [f"a{i}" for i in range(2000)], expected=1, buckets=2)
    asked = frame(spark, ["a5", "a1999", *[f"c{i}" for i in range(300)]])
    assert index.load() > 0.95 and index.maybe(asked).count() > 250
    assert keys_of(index.known(asked)) == ["a1999", "a5"]
    assert index.absent(asked).count() == 300


def test_cold_buckets_are_not_read(spark, tmp_path):
    index = made(spark, tmp_path, [f"a{i}" for i in range(1000)], buckets=32)
    asked = frame(spark, ["a3", "a700", "new"])
    of = {r.k: r.bucket for r in index._hashed(asked).collect()}
    hot = {of["a3"], of["a700"]}
    for name, buckets in (("filter", set(of.values())), ("keys", hot)):
        part = index._part(name, sorted(buckets))
        scan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in scan and "bucket" in scan.split("PartitionFilters")[1][:60]
        # files that a task opens, told by the rows themselves
        opened = {int(re.search(r"bucket=(\d+)", r.f)[1]) for r in
                  part.select(F.input_file_name().alias("f")).distinct().collect()}
        assert opened <= buckets < set(range(32))
    # take the cold folders away: the answer stands without them
    import os
    import shutil
    for name, keep in (("filter", set(of.values())), ("keys", hot)):
        for b in range(32):
            at = f"{index.path}/{name}/bucket={b}"
            if b not in keep and os.path.isdir(at):
                shutil.move(at, str(tmp_path / f"away-{name}-{b}"))
    assert keys_of(KeyIndex(spark, index.path).known(asked)) == ["a3", "a700"]


def test_runs_count_when_committed(spark, tmp_path):
    index = made(spark, tmp_path, ["a"], expected=100)
    index.add(frame(spark, ["b", "c"]), "r1")          # the writer dies here
    assert keys_of(index.known(frame(spark, ["a", "b", "c"]))) == ["a"]
    prod = frame(spark, ["a", "b"])                    # of the run's rows one had arrived
    assert index.recover(prod) == ["r1"] and index.recover(prod) == []
    assert keys_of(index.known(frame(spark, ["a", "b", "c"]))) == ["a", "b"]
    index.add(frame(spark, ["c"]), "r2")
    index.add(frame(spark, ["c"]), "r2")               # a repeated step
    index.commit("r2")
    assert keys_of(index.known(frame(spark, ["c"]))) == ["c"]
    assert keys_of(made(spark, tmp_path, [], name="empty").known(frame(spark, ["a"]))) == []


def test_insert_if_absent_twice(spark, tmp_path):
    index = KeyIndex.create(spark, str(tmp_path / "ix2"), ["k", "j"], 1000)
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")],
                                 "k string, j int, v string")
    assert insert_if_absent_indexed(rows, index, path, "r1").count() == 3
    more = rows.unionByName(spark.createDataFrame([("c", 9, "w")], rows.schema))
    assert [tuple(r) for r in insert_if_absent_indexed(more, index, path, "r2").collect()] == [("c", 9, "w")]
    assert read_if_present(spark, path).count() == 4


def test_publishing_again_gives_nothing(spark, tmp_path):
    from conftest import SF_SMALL
    from wapspark.sources.tables import AS_OF, transactions
    audit = transactions(spark, SF_SMALL, "dup")
    index = KeyIndex.create(spark, str(tmp_path / "ix"), ["transaction_id"], 10000, 8)
    first = publish.publish_indexed(audit, index, as_of=AS_OF).checkpoint()
    assert first.count() > 0
    index.add(first, "r1")
    index.commit("r1")
    assert publish.publish_indexed(audit, index, as_of=AS_OF).count() == 0


def test_a_batch_is_computed_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from wapspark.operators.key_index import KeyIndex
    index = KeyIndex.create(spark, str(tmp_path / "index"), ["k"], 100, buckets=4)
    index.add(spark.range(0, 50).withColumnRenamed("id", "k"), "a")
    index.commit("a")
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f
    batch = spark.range(0, 80).withColumnRenamed("id", "k").mapInPandas(count, "k long")
    got = index.absent(batch).agg(F.count("k"), F.min("k"), F.max("k")).first()
    assert tuple(got) == (30, 50, 79) and seen.value == 80
