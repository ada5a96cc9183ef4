"""Files landing between runs are each ingested once; restart-safe."""

import tempfile

import pytest

from pyspark.sql import functions as F

from wapspark.streaming.bronze_stream import ingest_bronze_stream, state_rows


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_ingests_new_files_once(spark):
    base = tempfile.mkdtemp(prefix="wap-stream-")
    src, acc, rej, ck = (f"{base}/{d}" for d in ("src", "acc", "rej", "ck"))
    import os
    os.makedirs(src)
    _write(f"{src}/a.json", ['{"id": "t1", "user_id": 1, "amount": "10.00"}',
                             '', '{"id": "t2", "user_id": 2, "amount": "abc"}'])
    _write(f"{src}/b.json", ['{"id": "", "user_id": 3, "amount": "5.00"}',
                             '{"id": "t3", "user_id": null, "amount": "1.50"}'])
    q = ingest_bronze_stream(spark, src, acc, rej, ck)
    q.awaitTermination(120)
    accepted = spark.read.parquet(acc)
    assert accepted.count() == 3  # t1, uuid row, t3 (NULL user kept)
    rejected = spark.read.parquet(rej)
    assert [r.reject_reasons for r in rejected.collect()] == ["bad_amount"]

    # second run: one new file, with a repeat of t1 and a new id
    _write(f"{src}/c.json", ['{"id": "t1", "user_id": 1, "amount": "10.00"}',
                             '{"id": "t4", "user_id": 4, "amount": "2.00"}'])
    q = ingest_bronze_stream(spark, src, acc, rej, ck)
    q.awaitTermination(120)
    accepted = spark.read.parquet(acc)
    ids = sorted(r.transaction_id for r in accepted.filter(F.col("transaction_id").startswith("t")).collect())
    assert ids == ["t1", "t3", "t4"]
    assert accepted.count() == 4
    # restart with nothing new: no change
    q = ingest_bronze_stream(spark, src, acc, rej, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(acc).count() == 4


def test_no_record_is_lost(spark):
    import os
    base = tempfile.mkdtemp(prefix="wap-stream-")
    src, acc, rej, ck = (f"{base}/{d}" for d in ("src", "acc", "rej", "ck"))
    os.makedirs(src)
    _write(f"{src}/a.json", ['{"id": "t1", "user_id": 1, "amount": "10.00"}',
                             '{"id": "t1", "user_id": 2, "amount": "20.00"}',
                             '{"id": "t1", "user_id": 3, "amount": "30.00"}', 'not json'])
    ingest_bronze_stream(spark, src, acc, rej, ck).awaitTermination(120)
    accepted, rejected = spark.read.parquet(acc).collect(), spark.read.parquet(rej).collect()
    assert [r.transaction_id for r in accepted] == ["t1"] and len(accepted) + len(rejected) == 4
    assert sorted(r.reject_reasons for r in rejected) == ["duplicate_key", "duplicate_key",
                                                          "malformed_record"]


def _paths():
    import os
    base = tempfile.mkdtemp(prefix="wap-stream-")
    os.makedirs(f"{base}/src")
    return [f"{base}/{d}" for d in ("src", "acc", "rej", "ck")]


def _run(spark, paths, **kw):
    q = ingest_bronze_stream(spark, *paths, **kw)
    q.awaitTermination(180)
    assert q.exception() is None
    return q


def _record(path, ids, day):
    """A file of records that arrived on a given day."""
    import os
    _write(path, [f'{{"id": "{i}", "user_id": 1, "amount": "1.00"}}' for i in ids])
    at = 1_700_000_000 + day * 86_400
    os.utime(path, (at, at))


def _told(spark, paths):
    accepted = [r.transaction_id for r in spark.read.parquet(paths[1]).collect()]
    rejected = [(r.transaction_id, r.reject_reasons) for r in spark.read.parquet(paths[2]).collect()]
    return sorted(accepted), sorted(rejected)


def test_state_is_bounded_by_the_window(spark):
    paths = _paths()
    held = []
    for day in range(0, 60, 10):
        _record(f"{paths[0]}/d{day}.json", [f"d{day}-{i}" for i in range(50)], day)
        held.append(state_rows(_run(spark, paths, window="15 days")))
    # a day's 50 ids leave with the watermark, two windows at most remain
    assert held[0] == 50 and max(held) <= 4 * 50 and held[-1] <= held[3]
    accepted, rejected = _told(spark, paths)
    assert len(accepted) == 300 and rejected == []


def test_copies_across_batches_and_late_files(spark):
    paths = _paths()
    _record(f"{paths[0]}/a.json", ["t1", "t2", "t2"], 0)
    _run(spark, paths, window="30 days")
    _record(f"{paths[0]}/b.json", ["t1", "t3"], 20)   # a copy within the window
    _run(spark, paths, window="30 days")
    _record(f"{paths[0]}/c.json", ["t4"], 100)
    _run(spark, paths, window="30 days")
    _record(f"{paths[0]}/d.json", ["t3", "t5"], 21)   # arrived long before the newest file
    _run(spark, paths, window="30 days")
    accepted, rejected = _told(spark, paths)
    assert accepted == ["t1", "t2", "t3", "t4"]
    assert rejected == [("t1", "duplicate_key"), ("t2", "duplicate_key"),
                        ("t3", "late_record"), ("t5", "late_record")]


def test_a_refused_record_may_come_again(spark):
    paths = _paths()
    _write(f"{paths[0]}/a.json", ['{"id": "t1", "user_id": 1, "amount": "x"}'])
    _run(spark, paths)
    _write(f"{paths[0]}/b.json", ['{"id": "t1", "user_id": 1, "amount": "3.00"}'])
    _run(spark, paths)
    assert _told(spark, paths) == (["t1"], [("t1", "bad_amount")])


def test_replayed_batch_replaces_itself(spark, monkeypatch):
    from pyspark.errors import StreamingQueryException
    from wapspark.streaming import bronze_stream
    paths = _paths()
    _record(f"{paths[0]}/a.json", ["t1", "t2"], 0)
    _run(spark, paths)
    _record(f"{paths[0]}/b.json", ["t2", "t3", ""], 1)

    def dies(*args):
        raise RuntimeError("after the output is written, before the batch is committed")
    with monkeypatch.context() as m:
        m.setattr(bronze_stream, "_note_arrivals", dies)
        with pytest.raises(StreamingQueryException):
            _run(spark, paths)
    before = _told(spark, paths)
    _run(spark, paths)
    after = _told(spark, paths)
    assert len(before[0]) == len(after[0]) == 4 and after[1] == before[1] == [("t2", "duplicate_key")]


def test_accepted_table_is_never_read_back(spark):
    """What was accepted before comes from the state: the files may be gone."""
    import shutil
    paths = _paths()
    _record(f"{paths[0]}/a.json", ["t1"], 0)
    _run(spark, paths)
    shutil.move(paths[1], f"{paths[1]}-archived")
    _record(f"{paths[0]}/b.json", ["t1", "t2"], 1)
    _run(spark, paths)
    assert _told(spark, paths)[0] == ["t2"]
