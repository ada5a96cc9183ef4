"""A filter on two of the columns reads a stated share of the files."""

import random

from pyspark.sql import functions as F

from wapspark.sources.clustered import ClusteredTable


def made(spark, n=20000):
    rng = random.Random(1)
    rows = [(i, rng.randrange(1000), 0 if rng.random() < 0.33 else rng.randrange(500),
             rng.choice(["alpha", "beta", "gamma", None]), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, day int, user int, kind string, v double").checkpoint()


def test_two_column_filter_reads_few_files(spark, tmp_path):
    df = made(spark)
    table = ClusteredTable(spark, str(tmp_path / "t"))
    table.write(df, ["day", "user", "kind"], files=64)
    total = len(table.files({}))
    assert total >= 48
    ranges = {"day": (100, 200), "user": (250, 300)}
    want = df.filter("day between 100 and 200 and user between 250 and 300")
    got = table.read(ranges)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) and want.count() > 50
    assert len(table.files(ranges)) <= total // 6
    opened = got.select(F.input_file_name()).distinct().count()
    assert opened <= len(table.files(ranges))
    # either column alone prunes, too, and so does the name
    assert len(table.files({"day": (100, 200)})) <= total // 2
    assert len(table.files({"user": (250, 300)})) <= total // 2
    assert len(table.files({"kind": ("beta", "beta")})) < total
    # a hot value spans files and is read whole
    assert table.read({"user": (0, 0)}).count() == df.filter("user = 0").count()
    assert len(table.files({"user": (0, 0)})) > 1


def test_open_ends_nulls_and_empty_tables(spark, tmp_path):
    df = made(spark, 500)
    table = ClusteredTable(spark, str(tmp_path / "t"))
    table.write(df, ["day", "kind"], files=8)
    assert table.read({"day": (900, None)}).count() == df.filter("day >= 900").count()
    assert table.read({"kind": (None, "beta")}).count() == df.filter("kind <= 'beta'").count()
    assert table.read({"day": (5000, None)}).count() == 0
    assert sorted(r.id for r in table.read().collect()) == list(range(500))
    pinned = table.read()
    table.write(df.limit(0).checkpoint(), ["day", "kind"], files=8)
    assert table.read().count() == 0 and table.read({"day": (1, 2)}).count() == 0
    assert pinned.count() == 500


def test_places_take_few_comparisons_and_equal_a_count_of_edges(spark):
    from wapspark.sources.clustered import _at, curve_place
    df = spark.range(3000).selectExpr("cast(id % 700 as double) as a", "if(id % 9 = 0, null, cast(id as string)) as b")
    placed = curve_place(df, ["a", "b"])
    assert placed.columns == ["a", "b", "_place"] and placed.filter("_place is null").count() == 0
    # An edge is compared once in the plan, however many bits are taken of a place.
    assert placed._jdf.queryExecution().optimizedPlan().toString().count(">=") <= 2 * 63
    edges = [1.0, 2.5, 2.75, 600.0]
    got = df.select("a", _at(F.col("a"), edges).alias("n")).distinct().collect()
    assert all(r.n == sum(r.a >= e for e in edges) for r in got)
    assert spark.sql("select cast(null as double) a").select(_at(F.col("a"), edges)).first()[0] == 0


def test_layout_by_stretches_leaves_the_same_rows_and_few_files_to_read(spark, tmp_path):
    df, told = made(spark), []
    table = ClusteredTable(spark, str(tmp_path / "t"))
    table.write(df, ["day", "user", "kind"], files=64, steps=6, spent=lambda: told.append(len(table.data.versions())))
    assert told == [0]  # the rows are stored before any is laid out
    assert sorted(map(repr, table.read().collect())) == sorted(map(repr, df.collect()))
    total, ranges = len(table.files({})), {"day": (100, 200), "user": (250, 300)}
    assert 48 <= total <= 80 and len(table.files(ranges)) <= total // 5
    want = df.filter("day between 100 and 200 and user between 250 and 300")
    assert sorted(r.id for r in table.read(ranges).collect()) == sorted(r.id for r in want.collect())
    table.write(df.limit(0).checkpoint(), ["day", "kind"], files=8, steps=4)
    assert table.read().count() == 0 and table.read({"day": (1, 2)}).count() == 0
