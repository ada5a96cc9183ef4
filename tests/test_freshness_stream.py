"""O1 by event-time timers: the same changes however arrivals are cut into batches."""

import datetime as dt
import random

import numpy as np

from wapspark.streaming import freshness_stream as S

H = S._HOUR
T0 = dt.datetime(2024, 1, 1)


def plain(times, mark_ms):
    """Changes of a feed from all its arrivals at once."""
    out, times = [], sorted(set(times))
    for i, t in enumerate(times):
        gap = times[i + 1] - t if i + 1 < len(times) else None
        if i == 0 or t - times[i - 1] > 2 * H:
            out.append(("FRESH", t))
        out += [(name, t + h * H) for name, h in (("STALE", 2), ("MISSING", 6)) if gap is None or gap > h * H]
    return sorted((at, s) for s, at in out if at // 1000 + 1 < mark_ms)


def test_any_order_within_the_delay_gives_the_same_changes():
    rng = random.Random(3)
    for _ in range(300):
        times = [rng.randrange(0, 40) * H // 2 + rng.randrange(3) for _ in range(rng.randrange(1, 25))]
        got, status, starts, ends, mark = [], S.MISSING, [], [], 0
        left = sorted(times)
        while left or mark < 60 * H // 1000:
            batch, left = left[:3], left[3:]
            # two of the batch come late by one batch, as long as the watermark allows
            rng.shuffle(batch)
            if batch:
                first, last = S.spans(np.array(starts + batch, np.int64), np.array(ends + batch, np.int64))
                starts, ends = first.tolist(), last.tolist()
            mark = min(left) // 1000 if left else mark + rng.randrange(1, 5) * H // 1000
            out, status, starts, ends, due = S.settle(status, starts, ends, lambda m: m // 1000 + 1 < mark)
            got += out
        assert sorted((at, s) for s, at in got) == plain(times, mark)
        assert due is None or due // 1000 + 1 >= mark


def run(spark, base, rows, k, delay="10 minutes"):
    if rows:
        spark.createDataFrame([(f, T0 + dt.timedelta(minutes=m) if m is not None else None) for f, m in rows],
                              "feed string, ts timestamp_ntz").coalesce(1).write.parquet(f"{base}/in/{k}")
    q = S.watch_freshness(spark, f"{base}/in", "feed string, ts timestamp_ntz", "feed", "ts",
                          f"{base}/out", f"{base}/state", delay)
    q.awaitTermination(180)
    assert q.exception() is None
    return q


def test_stale_and_missing_when_nothing_comes(spark, tmp_path):
    base = str(tmp_path)
    run(spark, base, [("a", 0), ("a", 60), ("b", 30), ("c", None), (None, 5)], 0)
    run(spark, base, [("b", 300)], 1)                    # a says nothing, b was away for 4.5 hours
    run(spark, base, [("b", 200), ("b", 301)], 2)        # 200 is late
    q = run(spark, base, [("b", 1000)], 3)               # time goes on without a
    got = sorted((r.feed, int((r.changed_at - T0).total_seconds() // 60), r.status)
                 for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("a", 0, "FRESH"), ("a", 180, "STALE"), ("a", 420, "MISSING"),
                   ("b", 30, "FRESH"), ("b", 150, "STALE"), ("b", 300, "FRESH"),
                   ("b", 421, "STALE"), ("b", 661, "MISSING")]
    held = sum(x["numRowsTotal"] for x in q.lastProgress["stateOperators"])
    assert held == 1                                     # b alone; a's state is gone


def test_many_feeds_at_once_are_as_each_alone():
    rng = random.Random(5)
    for _ in range(60):
        alone = {f: (S.MISSING, [], []) for f in "abcdefg"}
        held = (np.array([], object), *(np.array([], np.int64),) * 3)
        mark, got, want = 0, [], []
        for _ in range(8):
            new = [(rng.choice("abcdefg"), mark * 1000 + rng.randrange(1, 20) * H // 2 + rng.randrange(3))
                   for _ in range(rng.randrange(0, 14))]
            if new:
                f, t = np.array([x for x, _ in new], object), np.array([x for _, x in new], np.int64)
                held = S.joined(np.concatenate((held[0], f)), np.concatenate((held[1], t)),
                                np.concatenate((held[2], t)), np.concatenate((held[3], np.zeros_like(t))))
            mark += rng.randrange(0, 9) * H // 1000
            passed = lambda m: m // 1000 + 1 < mark  # noqa: B023, E731
            out, held, due = S.settled(*held, passed)
            got += zip(*(x.tolist() for x in out))
            dues = []
            for f, (status, starts, ends) in alone.items():
                own = [t for x, t in new if x == f]
                if own or starts:
                    first, last = S.spans(np.array(starts + own, np.int64), np.array(ends + own, np.int64))
                    changes, *left, at = S.settle(status, first.tolist(), last.tolist(), passed)
                    alone[f], dues = tuple(left), dues + ([at] if at is not None else [])
                    want += [(f, s, at) for s, at in changes]
            assert due == min(dues, default=None) and set(held[0]) == {f for f, x in alone.items() if x[1]}
        assert sorted(got) == sorted(want)


def test_a_call_steps_a_bucket_of_feeds(spark, tmp_path):
    base = str(tmp_path)
    q = run(spark, base, [(f"f{k}", k % 50) for k in range(3000)], 0)
    assert sum(x["numRowsTotal"] for x in q.lastProgress["stateOperators"]) <= 1024
    run(spark, base, [("late", 1000)], 1)
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 9000 and out.groupBy("status").count().count() == 3
    assert out.select("feed").distinct().count() == 3000
